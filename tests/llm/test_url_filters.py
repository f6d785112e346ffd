import random

from plain import components

from quarry.llm import url_filters as U
from quarry.llm.components import connected_components


def verdicts(frame, spark, rows, edges=None):
    rules = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    pages = frame("page_id long, url string, html string", rows, clashing=("host", "path", "rule", "verdict", "node", "a", "b"))
    more = edges and spark.createDataFrame(edges, "a string, b string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.url_filter(pages, rules, more).collect()}


def test_rules_hosts_and_paths(frame, spark):
    rows = [(1, "http://A.Example.NET/en/x?q#f", None), (2, "http://example.net/de/", ""), (3, "https://notexample.com/de/", None),
            (4, "ftp://x.example.com/de/1", None), (5, "http://w.org/fr/", None), (6, None, None), (7, "no scheme", "<p>"), (8, "http://net", None),
            (9, "http://b.net/", None), (10, "http://example.net?x=/en/", None), (11, "x://", None), (12, "http://EXAMPLE.com/DE/", None), (13, "http://.net/x", None)]
    got = verdicts(frame, spark, rows)
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2] == ("example.net", "/de/", "net/", "block")
    assert got[3] == ("notexample.com", "/de/", None, "allow") and got[4] == ("x.example.com", "/de/1", "example.com/de/", "block")
    assert got[5] == ("w.org", "/fr/", "org/fr/", "allow") and got[6] == ("", "", None, "allow") and got[7] == ("", "", None, "allow")
    assert got[8] == ("net", "", None, "allow") and got[9] == ("b.net", "/", "net/", "block") and got[10] == ("example.net", "", None, "allow")
    assert got[11] == ("", "", None, "allow") and got[12] == ("example.com", "/DE/", None, "allow") and got[13] == (".net", "/x", "net/", "block")


def test_aliases_take_over_blocks_and_allow_comes_first(frame, spark):
    canonical = '<link data-x=1 REL="canonical" href="{}">'.format
    rows = [(1, "http://a.test/1", canonical("http://bad.net/x#f")), (2, "http://a.test/2", canonical("/1")),
            (3, "http://a.test/3", '<meta http-equiv=refresh content="0; url=http://A.test/2">'), (4, "http://a.test/4", ""),
            (5, "http://w.org/fr/5", canonical("http://bad.net/y")), (6, "http://a.test/6", canonical("http://bad.net/y")),
            (7, "http://a.test/7", canonical("http://x.test/?a=1&amp;b=2")), (8, "http://x.test/?a=1&b=2", None), (9, "http://a.test/dir/9", canonical("other")),
            (10, "http://a.test/dir/other#top", ""), (11, "http://bad.net/q", ""), (12, "http://a.test/12", ""), (1, "http://a.test/1", None)]
    got = verdicts(frame, spark, rows, [("http://a.test/12", "http://hop.test/"), ("http://hop.test/", "http://bad.net/q"), (None, "http://a.test/4")])
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow",
                                                9: "allow", 10: "allow", 11: "block", 12: "block"}
    assert verdicts(frame, spark, []) == {}


def test_components_of_chains_hubs_and_random_graphs(spark):
    r = random.Random(11)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(200)] + [(r.randint(1000, 1200), r.randint(1000, 1200)) for _ in range(120)]
    edges += [(7, 7), (100, 101)]
    df = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    real = [(a, b) for a, b in edges if a != b]
    want = components({x for e in real for x in e}, real)
    assert {x.node: x.component for x in connected_components(df, "test").collect()} == want
    assert connected_components(df.limit(0), "test").count() == 0


def test_no_row_number_decides_a_verdict(frame):
    found = U.url_filter(frame("page_id long, url string, html string", [(1, "http://a.net/", None)]), frame("host string, path string, verdict string", [("net", "/", "block")]))
    assert "monotonically_increasing_id" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_generated_redirects_against_a_plain_walk(frame):
    import random

    r = random.Random(12)
    rules = [("net", "/", "block"), ("b.net", "/x/", "allow"), ("com", "/y/", "block"), ("org", "/", "allow")]
    urls = [f"http://{r.choice(['a.net', 'b.net', 'c.com', 'd.com', 'e.org', 'f.io', 'g.io', 'h.io', 'i.io'])}/{r.choice('xyz')}/{k}" for k in range(2000)]
    edges = [(r.choice(urls), r.choice(urls)) for _ in range(900)]
    near = {u: {u} for u in urls}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def rule(url):
        host, path = url[7:].split("/")[0], "/" + url[7:].split("/", 1)[1]
        fits = [(len(h + p), v, h + p) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        return max(fits) if fits else (0, None, None)
    want = []
    for k, u in enumerate(urls):
        group, todo = {u}, [u]
        while todo:
            for v in near[todo.pop()] - group:
                group.add(v)
                todo.append(v)
        _, verdict, named = rule(u)
        inherited = {rule(v)[1] for v in group} - {None}
        want.append((k, named, verdict or (min(inherited) if inherited else "allow")))
    pages = frame("page_id long, url string, html string", [(k, u, None) for k, u in enumerate(urls)])
    found = U.url_filter(pages, frame("host string, path string, verdict string", rules), frame("a string, b string", edges))
    assert sorted((x.page_id, x.rule, x.verdict) for x in found.collect()) == want
