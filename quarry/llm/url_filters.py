"""URL filters with redirect equivalence.

Rules name a host (with all its subdomains) and a path prefix; the longest
rule that fits a url decides. Urls that redirect to one another or name one
another as canonical are aliases: the connected components over those edges
carry block decisions from an url with a rule to its aliases without one. An
explicit allow comes first: an allowed url stays allowed whatever its
component, and an alias in a component that holds an explicit allow is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.decontamination import ascii_lower

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Tags that carry the edges, and the url in them.
CANONICAL_RE = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH_RE = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF_RE = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET_RE = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def same_url(url: Column) -> Column:
    """The url as a node: scheme and host in lower case, no fragment."""
    head = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(ascii_lower(head), rest))


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): normal forms of a page's url and of the urls that its canonical
    links and its refresh redirects name, relative ones resolved."""
    tags = F.concat(F.transform(F.regexp_extract_all("html", F.lit(CANONICAL_RE), F.lit(0)), lambda t: F.regexp_extract(t, HREF_RE, 1)),
                    F.transform(F.regexp_extract_all("html", F.lit(REFRESH_RE), F.lit(0)), lambda t: F.regexp_extract(t, TARGET_RE, 1)))
    named = (pages.filter(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.explode(tags).alias("to"))
             .withColumn("to", F.replace("to", F.lit("&amp;"), F.lit("&"))).filter(F.col("to") != ""))
    root = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"(?s)^(.*?://[^?#]*/)", 1)
    resolved = (F.when(F.col("to").contains("://"), F.col("to"))
                .when(F.col("to").startswith("//"), F.concat(F.regexp_extract("url", r"(?s)^(.*?:)//", 1), "to"))
                .when(F.col("to").startswith("/"), F.concat(root, "to"))
                .otherwise(F.concat(F.when(F.length(folder) > F.length(root), folder).otherwise(F.concat(root, F.lit("/"))), "to")))
    return named.select(same_url(F.col("url")).alias("a"), same_url(resolved).alias("b")).dropna()


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per different url of ``urls`` (url): url, rule, decided, the longest rule
    that fits it, if one does. ``rules`` has host, path, verdict; of equal rules
    with both verdicts allow wins. A host meets its rules by a join on its
    suffixes, so rules may be many; the url itself is the key, so nothing
    depends on the order of rows."""
    row = urls.select("url").distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = row.select("url", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("__host"))
    named = rules.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "verdict")
    return (suffixes.join(named, "__host").filter(F.col("path").startswith(F.col("__path")))
            .groupBy("url").agg(F.max(F.struct((F.length("__host") + F.length("__path")).alias("n"), (F.col("verdict") == "allow").alias("allow"),
                                               F.concat("__host", "__path").alias("rule"), "verdict")).alias("best"))
            .select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("decided")))


def url_filter(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    ``edges`` (a, b) are more redirects, as urls. A null url, or one without
    ``://``, has an empty host and path, no alias and no rule: it is allowed.
    An empty host fits no rule. Null html has no links. Repeated rows are
    judged each for itself; an empty table gives no rows, no rules allow
    everything. Urls and html of any length are read whole. Other columns are
    not read."""
    links = link_edges(pages.select("url", "html"))
    if edges is not None:
        links = links.unionByName(edges.select(same_url(F.col("a")).alias("a"), same_url(F.col("b")).alias("b")).dropna())
    members = connected_components(links, "url-aliases")
    found = judged(members.select(F.col("node").alias("url")), rules)
    verdicts = (members.join(found, F.col("node") == F.col("url")).groupBy("component")
                .agg(F.min("decided").alias("inherited")))  # allow before block
    aliases = members.join(verdicts, "component").select("node", "inherited")
    own = judged(pages.select("url"), rules).withColumnRenamed("url", "__url")
    rows = (pages.select("page_id", "url").join(own, F.col("url") == F.col("__url"), "left")
            .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "__node": same_url(F.col("url"))}))
    return (rows.join(aliases, F.col("__node") == F.col("node"), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("decided", "inherited", F.lit("allow")).alias("verdict")))
