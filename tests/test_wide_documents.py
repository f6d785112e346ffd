"""State documents are packed without hashing, sorting or shuffling wide rows."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from quarry.operators import normalize as N
from quarry.plans import adapters, catalog
from quarry.session import wide_documents

DAY = dt.datetime(1996, 1, 2)


def _tables(spark, path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    write("customer", [(1, "C1", 3, 1.0, "TOOLS"), (2, None, None, 1.0, None)],
          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("orders", [(1, 1, "F", 10.5, DAY, "1-URGENT"), (2, 1, "O", 9.0, DAY, "2-HIGH"), (3, 2, "F", None, DAY, "5-LOW"),
                     (4, 1, "P", 1.0, DAY, "5-LOW"), (5, 1, "F", 2.0, DAY, "5-LOW")],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    write("part", [(1, 'a "quoted"\\ name', "B#1", "T", 48), (2, None, None, None, 46), (3, "c", "B#3", "T3", None)],
          "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    line = lambda o, p, s, n, status="F": (o, p, s, n, 9.0, 0.05, 0.03, "N", status)
    write("lineitem", [line(1, 2, 6, 2), line(1, 1, 10, 1), line(1, 3, None, 3, "O"), line(2, 1, 1, 1), line(3, 2, 1, 1), line(3, 2, 1, 1)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double,"
          " l_returnflag string, l_linestatus string")
    return str(path)


def test_texts_of_quotes_nulls_and_repeated_lines(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    with wide_documents(spark):
        rows = {r["ordinal"]: r for r in adapters.snapshot_state(spark, sf).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[2]["characterData"] is rows[4]["passiveTree"] is None
    one, tree = json.loads(rows[1]["characterData"]), json.loads(rows[1]["passiveTree"])
    assert [i.get("name") for i in one["items"]] == ['a "quoted"\\ name', None, "c"]
    assert [i["requirements"][1]["values"][0][0] for i in one["items"]] == ["30 (gem)"] * 3
    assert tree["hashes"] == [1_000_000_001, 2, 3]
    assert tree["hashes_ex"] == [2_000_000_010, 2_000_000_011, 2_000_000_020, 2_000_000_021]
    assert list(tree["jewel_data"]) == ["0", "1"] and tree["mastery_effects"] == {"100": 10, "201": 6}
    assert list(tree["jewel_data"]["1"]["subgraph"]["nodes"]) == ["2000000020", "2000000022"]
    assert rows[5]["passiveTree"] == '{"hashes":[],"hashes_ex":[],"items":[],"jewel_data":{},"mastery_effects":{}}'
    assert json.loads(rows[5]["characterData"])["items"] == []
    assert len(json.loads(rows[3]["characterData"])["items"]) == 2 and "experience" not in json.loads(rows[3]["characterData"])["character"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packing_streams_the_ok_lines(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.execution.useObjectHashAggregateExec")
    with wide_documents(spark):
        plan = _plan(adapters.snapshot_state(spark, sf))
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == before
    assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate") == 2
    assert "LeftSemi" in plan  # lines of other orders are not packed


def test_dedupe_hashes_the_ids_not_the_rows(spark):
    raw = spark.createDataFrame([(1, "a", "b", "2024", "x"), (2, "a", "b", "2025", "y"), (3, "c", None, None, "z")],
                                "ordinal long, account string, character string, fetchedAt string, items string")
    latest = N.latest_per_identity(raw)
    assert "SortMergeJoin" not in _plan(latest) and "ShuffledHashJoin" in _plan(latest)
    assert {r["ordinal"] for r in latest.collect()} == {2, 3}


def test_verbatim_check_moves_no_payload(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    found = catalog.q_raw(spark, sf)
    assert "get_json_object" not in _plan(found).split("Join")[0]
    assert {(r["n_items"], r["n_hashes"], r["verbatim"]) for r in found.collect()} == {(3, 3, True), (0, 0, True), (2, 2, False)}  # a null account has no key
    assert found.where(F.col("character_key") == "C1/1-URGENT").count() == 1
