"""Rows kept by their ids where they stand, and the dedupe that does so."""

from __future__ import annotations

import pytest

from quarry.operators import common
from quarry.operators import normalize as N
from quarry.plans import adapters
from tests.test_wide_documents import _tables

IDS = [0, 1, 7, 8, 32767, 32768, 32769, 65536, -1, -32768, 10**12, 7, None]


@pytest.mark.parametrize("bitmaps", [8_192, 0])
def test_rows_are_kept_by_id(spark, monkeypatch, bitmaps):
    monkeypatch.setattr(common, "BROADCAST_BITMAPS", bitmaps)
    held = [*IDS, *IDS, 2, 6, 9, 32766, 65535, 65537, -2, -32767, 10**12 + 1, 10**12 - 8]
    df = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(held)], "id long, text string")
    got = common.keep_ids(df, spark.createDataFrame([(i,) for i in IDS], "id long"), "id").collect()
    assert sorted((r.id, r.text) for r in got) == sorted((i, f"t{n}") for n, i in enumerate(held) if i is not None and i in IDS)


def test_no_id_keeps_no_row(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id long, text string")
    assert common.keep_ids(df, df.where("id > 1").select("id"), "id").count() == 0


def _lines(spark):
    return spark.createDataFrame([
        (1, "a", "x", "2024-01-01", "one"), (2, "a", "x", "2024-01-03", "two"), (3, "a", "x", "2024-01-03", "three"),
        (4, "b", "x", None, "four"), (5, "b", "x", None, "five"), (6, None, "x", "2024-01-01", "six")],
        "ordinal long, account string, character string, fetchedAt string, items string")


def test_dedupe_in_place_keeps_the_same_rows_and_does_not_shuffle_them(spark):
    lines = _lines(spark)
    moved, kept = N.latest_per_identity(lines), N.latest_per_identity(lines, in_place=True)
    assert sorted(r.ordinal for r in kept.collect()) == [3, 5, 6]
    assert sorted(map(str, kept.collect())) == sorted(map(str, moved.collect()))
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan and "SortMergeJoin" not in plan


def test_lines_of_other_orders_are_dropped_before_the_first_shuffle(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables beyond it
    try:
        plan = adapters.snapshot_state(spark, sf)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in next(line for line in plan.splitlines() if "LeftSemi" in line)
