"""R4 with timers and compaction against a plain replay."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.session import checkpoint_root
from quarry.sources import sinks
from quarry.streaming import keyed

KIND = "k long, name string, seq long, ts timestamp, amount double, note string"
START = dt.datetime(2024, 1, 1)


def _row(k, seq, hour, note="x", name="a"):
    return (k, name, seq, None if hour is None else START + dt.timedelta(hours=hour, microseconds=seq), seq / 4, note)


def _write(spark, path, rows):
    spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(path)


def _run(spark, src, out, **more):
    schema = spark.createDataFrame([], KIND).schema
    return keyed.keyed_state(spark, src, schema, out, ["k", "name"], ["seq"], "ts", 10 * 3_600_000, "1 hour", **more)


def _found(spark, table):
    return {(r.k, r.name): (r.seq, r.ts, r.amount, r.note) for r in keyed.read_keyed(spark, table, ["k", "name"]).collect()}


def test_newest_rows_timers_restart_and_compaction(spark):
    root = checkpoint_root(spark, "keyed-test", unique=True)
    src, out = f"{root}/in", f"{root}/out"
    hot = [_row(7, 1000 + i, 0.5 + i / 1000, "hot") for i in range(500)]
    batches = [
        [_row(1, 1, 0), _row(2, 2, 0, None), _row(None, 3, 0), _row(1, 9, 0, "late order"), *hot],
        [_row(1, 5, 2, "older by order"), _row(2, 6, 2, "newer"), _row(3, 7, None), _row(3, 8, 2)],
        [_row(4, 10, 20)],  # the others go quiet: the watermark is at 19
        [_row(2, 4, 21, "comes back, older by order")],
        [_row(4, 11, 22)], [_row(4, 12, 23)], [_row(4, 13, 24)],
    ]
    _write(spark, src, batches[0])
    table = _run(spark, src, out, compact_every=2)
    assert _found(spark, table) == {(k, "a"): (s, t, a, n) for k, _, s, t, a, n in (_row(1, 9, 0, "late order"), _row(2, 2, 0, None), _row(None, 3, 0), hot[-1])}
    _write(spark, src, batches[1])
    _run(spark, src, out, compact_every=2)
    now = _found(spark, table)
    assert {k[0]: v[0] for k, v in now.items()} == {1: 9, 2: 6, None: 3, 7: 1499, 3: 8}
    for batch in batches[2:]:
        _write(spark, src, batch)
        _run(spark, src, out, compact_every=2)
    # 2 had been forgotten, so its older line starts it anew; 4 is the only other one that is not quiet.
    assert {k[0]: v[0] for k, v in _found(spark, table).items()} == {2: 4, 4: 13}
    left = keyed._numbers(spark, f"{table}/updates"), keyed._numbers(spark, f"{table}/base")
    assert len(left[1]) == 2 and len(left[0]) <= 4 and min(left[0]) > left[1][0]
    # A batch that comes again after its base was cut off changes nothing.
    before = _found(spark, table)
    path, fs = sinks._fs(spark, f"{table}/base/upto={left[1][-1]}/_SUCCESS")
    fs.delete(path, False)
    assert _found(spark, table) == before
    keyed.compact(spark, table, ["k", "name"], left[1][-1])
    assert _found(spark, table) == before


def test_ranks_order_as_spark_does(spark):
    rows = [("é",), ("z",), (None,), ("a\"b",), ("",), ("𐀀",), ("￿",)]
    df = spark.createDataFrame(rows, "s string")
    rank = F.concat(F.lit("["), F.when(F.col("s").isNull(), F.lit("[]")).otherwise(F.to_json(F.array("s"))), F.lit("]"))
    got = [r.s for r in df.withColumn("r", rank).orderBy("s").collect()]
    mine = [r.s for r in sorted(df.withColumn("r", rank).collect(), key=lambda r: keyed._place(r.r))]
    assert got == mine
