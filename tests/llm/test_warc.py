import base64
import hashlib
import random

from quarry.llm import warc as W
from quarry.llm.common import scratch

ROWS = [(1, "http://a/ b\r\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n\x1f\x8b" * 9), (6, "u", "z" * 300_000),
        (6, "u", "z" * 300_000), (None, "n", "only"), (None, "n", "z" * 300_000)]


def test_round_trip_through_files(spark, frame):
    path = scratch(spark, "warc-test")
    W.write_archives(frame("page_id long, url string, html string", ROWS, clashing=("digest", "n", "original", "body")), path, records_per_file=2)
    got = W.read_archives(spark, path).collect()
    assert {r.kind for r in got} == {"record"} and len(got) == len(ROWS)
    key = lambda p: hashlib.sha1((p or "").encode()).digest()
    last = {}
    for page, _, body in ROWS:
        last[key(body)] = max(last.get(key(body), -1), -1 if page is None else page)
    for r in got:
        digest = base64.b32decode(r.payload_digest)
        original = None if last[digest] == -1 else last[digest]
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == original else ("revisit", original))
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).digest() == digest and len(r.payload) == r.payload_bytes
    assert sorted(r.payload_bytes for r in got) == sorted(len((x or "").encode()) for _, _, x in ROWS)
    assert W.read_archives(spark, path, with_payload=False).select("payload").distinct().collect() == [(None,)]
    empty = scratch(spark, "warc-test")
    W.write_archives(frame("page_id long, url string, html string", ROWS).limit(0), empty)
    assert W.read_archives(spark, empty).count() == 0


def _file(r, n, plain):
    parts = []
    for i in range(n):
        data = W.record(i, f"http://x/{i}", bytes(r.randrange(256) for _ in range(r.randint(0, 400))), None, False)
        parts.append(data if plain(i) else W.member(data))
    return parts


def test_salvage_recovers_what_is_sound_and_logs_the_rest():
    r = random.Random(12)
    for trial in range(60):
        parts = _file(r, 12, lambda i: trial % 3 == 0 or trial % 3 == 1 and i % 2)
        hurt = set(r.sample(range(12), r.randint(0, 4)))
        for i in hurt:
            p = bytearray(parts[i])
            if r.random() < 0.4:
                del p[r.randrange(1, len(p)):]
            else:
                p[r.randrange(len(p))] ^= 1 << r.randrange(8)
            parts[i] = bytes(p)
        junk = b"junk \x1f\x8b\x08 WARC/1.0\r\n" if trial % 5 == 0 else b""
        content = junk + b"".join(parts)
        found = list(W.salvage(content))
        pages = [W._page_id(x[3]["warc-record-id"]) for x in found if x[0] == "record" and W._described(x[3], x[4])[0] is None]
        assert set(range(12)) - hurt <= set(pages)
        edge = 0
        for kind, start, end, *_ in found:
            assert start == edge
            edge = end
        assert edge == len(content)
        assert bool(junk) <= any(x[0] == "gap" for x in found)
    assert list(W.salvage(b"")) == [] and [x[0] for x in W.salvage(b"nothing")] == ["gap"]


def test_sound_records_of_a_damaged_member_are_recovered():
    r = random.Random(5)
    words = [" ".join(r.choice(("one", "two", "three", "four", "é")) for _ in range(400)).encode() for _ in range(3)]
    before, after = W.member(W.record(8, "u", b"before", None, False)), W.member(W.record(9, "u", b"after", None, False))
    plain = b"".join(W.record(i, "u", w, None, False) for i, w in enumerate(words))
    pages = lambda content: [W._page_id(x[3]["warc-record-id"]) for x in W.salvage(content) if x[0] == "record"]
    # A wrong byte in the second record, the member's sum being that of the whole.
    at = plain.index(words[1]) + 40
    hurt = bytearray(W.member(plain[:at] + b"#" + plain[at + 1:]))
    hurt[-8:-4] = W.member(plain)[-8:-4]
    found = list(W.salvage(before + bytes(hurt) + after))
    assert pages(before + bytes(hurt) + after) == [8, 0, 2, 9]
    gap, = [x for x in found if x[0] == "gap"]
    assert gap[1:3] == (len(before), len(before) + len(hurt)) and [x[1:3] for x in found[1:3]] == [(len(before),) * 2] * 2
    # Cut short: the records before the cut.
    whole = W.member(plain)
    assert pages(whole[:-12] + after)[:2] == [0, 1] and pages(whole[:-12] + after)[-1] == 9
    assert pages(whole[:-2]) == [0, 1, 2] and pages(whole) == [0, 1, 2]
    # Any byte: what is found is right, the neighbours are never lost.
    for place in range(10, len(whole), 37):
        broken = bytearray(whole)
        broken[place] ^= 0x55
        got = [(W._page_id(x[3]["warc-record-id"]), x[4]) for x in W.salvage(before + bytes(broken) + after) if x[0] == "record"]
        assert got[0][0] == 8 and got[-1][0] == 9
        assert all(block.partition(b"\r\n\r\n")[2] in words for _, block in got[1:-1])
    # A record without a digest that proves it stays in the gap.
    bare = bytearray(W.member(_foreign("metadata", b"a: b") + W.record(1, "u", b"x", None, False)))
    bare[-8] ^= 1
    assert pages(bytes(bare)) == [1]


def test_files_are_bounded_by_bytes(spark, frame):
    path = scratch(spark, "warc-test")
    r = random.Random(3)
    rows = [(i, "u", "".join(chr(r.randrange(33, 0x3000)) for _ in range(3_000))) for i in range(60)]
    W.write_archives(frame("page_id long, url string, html string", rows, clashing=()), path, bytes_per_file=20_000)
    sizes = [x.n for x in spark.read.format("binaryFile").load(path).selectExpr("length AS n").collect()]
    largest = max(len(W.member(W.record(i, u, t.encode(), None, False))) for i, u, t in rows)
    assert len(sizes) > 10 and max(sizes) <= 20_000 + largest + 100
    assert W.read_archives(spark, path).where("kind = 'record'").count() == len(rows)


def test_query_keeps_pages_with_very_long_urls(spark, frame):
    from quarry.llm import queries
    folder = scratch(spark, "warc-test")
    rows = [(1, "http://a/" + "x" * 100_000, "<p>a</p>"), (2, "http://b/" + "y" * 1_000_000, "<p>b</p>"), (3, "u", "<p>b</p>")]
    frame("page_id long, url string, html string", rows, clashing=()).write.parquet(f"{folder}/pages.parquet")
    assert queries.QUERIES["op10_warc"](spark, folder).count() == len(rows)
    assert [x[0] for x in W.salvage(b"WARC/1.1\r\n" + b"no header \r\n" * 20_000)] == ["gap"]


def _foreign(kind, block, *more):
    head = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:92283950-ef2f-4d72-b224-f54c6ec90bb0>", f"Content-Length: {len(block)}", *more]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_sound_records_of_other_archives_are_records():
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"
    digest = f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'body').hexdigest()}"
    kind = "Content-Type: application/http; msgtype=response"
    parts = [_foreign("warcinfo", b"software: x"), _foreign("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request"),
             _foreign("response", http, kind, digest), _foreign("metadata", b"a: b", f"WARC-Block-Digest: sha1:{W.sha1_base32(b'a: b')}"),
             _foreign("revisit", b"", "WARC-Refers-To: <urn:uuid:1>"), _foreign("response", http + b"!", kind, digest)]
    found = [W._described(x[3], x[4]) for x in W.salvage(b"".join(map(W.member, parts))) if x[0] == "record"]
    assert [x[3] for x in found] == ["warcinfo", "request", "response", "metadata", "revisit", None] and "payload digest" in found[-1][0]
    assert {x[1] for x in found} == {None} and all(x[7].startswith("<urn:uuid:") for x in found[:-1])
    assert [x[8] for x in found[:-1]] == [b"software: x", b"", b"body", b"a: b", None] and found[4][4] is None
