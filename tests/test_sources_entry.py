"""Entry smoke, strict vs lenient state scans (failure injection), tree shapes."""

import gzip
import json
import os
import tempfile

import pytest

from quarry.sources.state import scan_results, scan_state
from quarry.sources.tree import normalize_tree


def _write_gz(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"kind", "name", "count", "percentage", "total"}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_strict_scan_rejects_corrupt_line(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    good = json.dumps({"ordinal": 0, "account": "a", "character": "A", "outcome": "pending"})
    _write_gz(os.path.join(d, "state.ndjson.gz"), [good, "", "{not json"])
    with pytest.raises(Exception):
        scan_state(spark, d).collect()
    ok_dir = tempfile.mkdtemp(prefix="quarry-test-")
    _write_gz(os.path.join(ok_dir, "state.ndjson.gz"), [good, "", good])
    assert scan_state(spark, ok_dir).count() == 2  # blank line skipped


def test_lenient_results_keep_lines_before_fault(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    line = lambda i: json.dumps({"account": "a", "character": str(i), "outcome": "ok"})
    _write_gz(os.path.join(d, "w00.ndjson.gz"), [line(0), line(1), "garbage", line(3)])
    _write_gz(os.path.join(d, "w01.ndjson.gz"), [line(4)])
    got = sorted(r["character"] for r in scan_results(spark, d).collect())
    assert got == ["0", "1", "4"]
    missing = scan_results(spark, os.path.join(d, "nope"))
    assert missing.count() == 0


def test_normalize_tree_both_shapes(spark):
    arr = json.dumps({"nodes": [{"hash": 1, "name": "A", "stats": ["s", 5], "isKeystone": True}]})
    obj = json.dumps({"nodes": {"root": {"name": "x"}, "2": {"name": "B", "is_keystone": True},
                                "3": {"stats": ["t"], "isKeystone": False, "is_keystone": True}}})
    docs = spark.createDataFrame([("v1", arr), ("v2", obj)], "version string, doc string")
    got = sorted((r["version"], r["hash"], r["name"], r["is_keystone"])
                 for r in normalize_tree(docs).collect())
    assert got == [("v1", 1, "A", True), ("v2", 2, "B", True), ("v2", 3, "", False)]


def test_write_state_roundtrip_and_raw_scan(spark):
    from quarry import schemas
    from quarry.sources.state import scan_raw, write_state
    rows = [dict(ordinal=i, account=f"a{i}", character="X", outcome="pending", attempts=0)
            for i in range(10)]
    state = spark.createDataFrame(rows, schemas.STATE_LINE)
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-test-"), "v1")
    write_state(state, out, partitions=3)
    back = scan_state(spark, out)
    assert sorted(r["ordinal"] for r in back.collect()) == list(range(10))
    text = open([os.path.join(out, f) for f in os.listdir(out) if f.endswith(".gz")][0], "rb").read()
    assert b"fetchedAt" not in gzip.decompress(text)  # absent fields stay absent
    with pytest.raises(Exception):
        write_state(state, out)  # never overwrite a version in place
    raw_dir = tempfile.mkdtemp(prefix="quarry-test-")
    _write_gz(os.path.join(raw_dir, "r.ndjson.gz"), [json.dumps(
        {"ordinal": 1, "rank": 1, "account": "a", "character": "A", "items": "{}", "passives": "{}"})])
    assert scan_raw(spark, raw_dir).first()["account"] == "a"


def test_results_line_order_survives_file_splits(spark):
    """A plain NDJSON file split into several partitions keeps line order."""
    from quarry.operators.state import merge_results
    from quarry import schemas
    d = tempfile.mkdtemp(prefix="quarry-test-")
    lines = [json.dumps({"account": "a", "character": "A", "outcome": "retryable", "attempts": i,
                         "pad": "x" * 200}) for i in range(3000)]
    lines[2000] = "garbage"
    with open(os.path.join(d, "w00.ndjson"), "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        res = scan_results(spark, d)
        assert res.rdd.getNumPartitions() > 3
        kept = res.select("attempts").collect()
        assert sorted(r["attempts"] for r in kept) == list(range(2000))
        state = spark.createDataFrame([dict(ordinal=0, account="a", character="A", outcome="pending",
                                            attempts=0)], schemas.STATE_LINE)
        merged = merge_results(state, res).first()
        assert merged["attempts"] == 1999  # the last line before the fault wins
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_truncated_gzip_strict_fails_lenient_keeps_prefix(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    lines = [json.dumps({"ordinal": i, "account": "a", "character": str(i), "outcome": "ok",
                         "pad": "x" * 50}) for i in range(2000)]
    data = gzip.compress(("\n".join(lines) + "\n").encode())
    with open(os.path.join(d, "w00.ndjson.gz"), "wb") as f:
        f.write(data[: len(data) // 2])  # cut mid-stream
    with pytest.raises(Exception):
        scan_state(spark, d).count()
    kept = scan_results(spark, d).count()
    assert 0 < kept < 2000
