"""Bucketed tables: copy on write, cut-off merges, plans without a shuffle of the rows."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import state as ST
from quarry.session import checkpoint_root
from quarry.sources import buckets as BK

LINE = "ordinal long, account string, character string, outcome string, attempts int, file string, seq long"
CHANGE = "account string, character string, outcome string, attempts int, file string, seq long"


@pytest.fixture
def table(spark):
    rows = [(i, f"a{i}", "c", "pending", 0, None, None) for i in range(40)] + [(40, None, "c", "pending", 0, None, None)]
    return BK.create(spark.createDataFrame(rows, LINE), checkpoint_root(spark, "buckets-test", unique=True), ST.IDENTITY, 8)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def lines(spark, table):
    return {r["account"]: (r["ordinal"], r["outcome"], r["seq"]) for r in BK.read(spark, table).collect()}


def test_only_touched_buckets_are_rewritten_and_order_decides(spark, table):
    assert BK.merge(spark, table, changes(spark), ST.replace_lines)["version"] == 0
    done = BK.merge(spark, table, changes(spark, ("a3", "c", "ok", 1, "w0", 5), ("none", "c", "ok", 1, "w0", 6), (None, "c", "ok", 1, "w0", 7)),
                    ST.replace_lines, ST.tally_deltas)
    pointer = BK._pointer(spark, table)
    assert done["rewritten"] <= 3 and pointer["at"].count("0") >= 8 - done["rewritten"] - pointer["at"].count(None)
    assert lines(spark, table)["a3"] == (3, "ok", 5) and len(lines(spark, table)) == 41 and lines(spark, table)[None][1] == "pending"
    # An older and the same result change nothing, a newer one does.
    for row, want in ((("a3", "c", "dead", 2, "w0", 4), "ok"), (("a3", "c", "dead", 2, "w0", 5), "ok"), (("a3", "c", "private", 2, "w1", 1), "private")):
        BK.merge(spark, table, changes(spark, row), ST.replace_lines, ST.tally_deltas)
        assert lines(spark, table)["a3"][1] == want
    found = BK.read_deltas(spark, table, "outcome string, delta long").groupBy("outcome").agg(F.sum("delta").alias("d")).collect()
    assert {r["outcome"]: r["d"] for r in found if r["d"]} == {"pending": -1, "private": 1}


def test_a_merge_that_is_cut_off_changes_nothing(spark, table, monkeypatch):
    before = lines(spark, table)
    monkeypatch.setattr(BK, "ROUTED_ROWS", 1)
    calls = []

    def fails(rows, own):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return ST.replace_lines(rows, own)
    some = changes(spark, *[(f"a{i}", "c", "ok", 1, "w0", i) for i in range(20)])
    with pytest.raises(RuntimeError):
        BK.merge(spark, table, some, fails, ST.tally_deltas)
    assert lines(spark, table) == before and BK.read_deltas(spark, table, "outcome string, delta long").count() == 0
    BK.merge(spark, table, some, ST.replace_lines, ST.tally_deltas)
    assert sum(v[1] == "ok" for v in lines(spark, table).values()) == 20


def test_rows_are_not_shuffled(spark, table):
    rows = BK.read(spark, table, with_bucket=True)
    own = changes(spark, ("a3", "c", "ok", 1, "w0", 5)).withColumn("__bucket", BK.bucket_of(ST.IDENTITY, 8))
    plan = ST.replace_lines(rows, own)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
