"""Skew-safe rewrites checked against brute force on random small logs."""

import random

import pytest

from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import requests as RQ
from quarry.operators import state as ST
from quarry.operators.common import latest_per_key, with_global_ordinal


def _log(seed, n=300, ips=3, span=50_000):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        rows.append((f"ip{rnd.randrange(ips)}", seq, rnd.randrange(span),
                     rnd.choice(["ok", "ok", "throttled", "error", "challenge"]),
                     rnd.choice([None, None, 1000])))
    return rows


def test_quota_audit_matches_brute_force(spark):
    rows = _log(7)
    df = spark.createDataFrame(rows, "ip string, seq long, ts_ms long, signal string, retry_ms long")
    windows = [(2, 1_000), (4, 7_000)]
    got = {(r["ip"], r["seq"], r["cap"]): (r["hits"], r["violation"], r["earliest_ms"])
           for r in RQ.quota_audit(df.select("ip", "seq", "ts_ms"), windows).collect()}
    for cap, period in windows:
        for ip in {r[0] for r in rows}:
            mine = sorted((r[2], r[1]) for r in rows if r[0] == ip)
            for idx, (ts, seq) in enumerate(mine):
                hits = sum(1 for t, _ in mine if ts - period < t <= ts)
                prev = mine[idx - cap][0] if idx - cap >= 0 else None
                viol = prev is not None and prev + period > ts
                assert got[(ip, seq, cap)] == (hits, viol, prev + period if viol else None)


def test_streaks_match_brute_force(spark):
    rows = _log(11, n=400)
    df = spark.createDataFrame(rows, "ip string, seq long, ts_ms long, signal string, retry_ms long")
    got = {(r["ip"], r["seq"]): (r["throttle_streak"], r["error_streak"], r["backoff_ms"], r["abort"])
           for r in RQ.danger_streaks(df, bucket_ms=2_000).collect()}
    for ip in {r[0] for r in rows}:
        t = e = 0
        for ts, seq, sig, retry in sorted((r[2], r[1], r[3], r[4]) for r in rows if r[0] == ip):
            thr = sig in ("throttled", "challenge")
            t = t + 1 if thr else 0
            e = e + 1 if sig == "error" else 0
            if thr:
                back = min(300_000, retry if retry is not None else 5000 * 2 ** (t - 1))
            elif sig == "error":
                back = min(300_000, retry if retry is not None else 2000 * 2 ** (e - 1))
            else:
                back = None
            assert got[(ip, seq)] == (t, e, back, t >= 3 or e >= 8), (ip, seq)


def test_latest_per_key_both_forms_and_ordinal(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(5), rnd.randrange(4), i, f"p{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, o long, id long, payload string")
    want = {}
    for k, o, i, p in rows:
        if k not in want or (o, i) > want[k][:2]:
            want[k] = (o, i, p)
    for form in (latest_per_key(df, ["k"], ["o", "id"]),
                 latest_per_key(df, ["k"], ["o", "id"], row_id="id")):
        assert {r["k"]: (r["o"], r["id"], r["payload"]) for r in form.collect()} == want
    out = with_global_ordinal(df, [F.col("o").desc(), "id"], partitions=5).collect()
    expect = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert [r["id"] for r in sorted(out, key=lambda r: r["ordinal"])] == [r[2] for r in expect]


def test_merge_results_idempotent_and_order_insensitive(spark):
    rnd = random.Random(5)
    state = spark.createDataFrame(
        [dict(ordinal=i, account=f"a{i}", character="X", outcome="pending", attempts=0) for i in range(20)],
        schemas.STATE_LINE)
    res_rows = [(f"a{rnd.randrange(25)}", "X", rnd.choice(["ok", "dead", "retryable"]), rnd.randrange(3),
                 f"w0{rnd.randrange(2)}", i) for i in range(200)]
    res = spark.createDataFrame(res_rows, "account string, character string, outcome string, "
                                          "attempts int, file string, seq long")
    once = ST.merge_results(state, res)
    twice = ST.merge_results(once, res)
    shuffled = ST.merge_results(state, res.orderBy(F.rand(1)))
    key = lambda d: sorted((r["ordinal"], r["outcome"], r["attempts"]) for r in d.collect())
    assert key(once) == key(twice) == key(shuffled)
    assert once.count() == 20


def test_stream_merge_resumes_and_is_idempotent(spark):
    import tempfile

    from quarry.streaming import incremental as SM
    rnd = random.Random(9)
    state = spark.createDataFrame(
        [(i, f"a{i}", "X", "pending", 0) for i in range(30)],
        "ordinal long, account string, character string, outcome string, attempts int")
    rows = [(f"a{rnd.randrange(35)}", "X", rnd.choice(["ok", "dead", "retryable"]), rnd.randrange(3),
             f"w0{rnd.randrange(2)}", i) for i in range(120)]
    schema = "account string, character string, outcome string, attempts int, file string, seq long"
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    src = f"{root}/results"
    spark.createDataFrame(rows[:60], schema).repartition(2).write.parquet(f"{src}/part1")
    first = SM.incremental_merge(spark, state, f"{src}/*", spark.createDataFrame([], schema).schema,
                                 root)
    assert first.count() == 30
    spark.createDataFrame(rows[60:], schema).repartition(2).write.parquet(f"{src}/part2")
    seen = []
    resumed = SM.incremental_merge(spark, state, f"{src}/*", spark.createDataFrame([], schema).schema,
                                   root, on_batch=lambda merged, batch: seen.append((batch, merged.count())))
    again = SM.incremental_merge(spark, state, f"{src}/*", spark.createDataFrame([], schema).schema,
                                 root)
    batch = ST.merge_results(state, spark.createDataFrame(rows, schema))
    key = lambda d: sorted((r["ordinal"], r["outcome"], r["attempts"]) for r in d.collect())
    assert key(resumed) == key(batch) == key(again)
    assert seen and all(n == 30 for _, n in seen)

    def fails(merged, batch_id):
        raise ValueError("no publish")
    with pytest.warns(UserWarning, match="no publish"):
        failing = SM.incremental_merge(spark, state, f"{src}/*", spark.createDataFrame([], schema).schema,
                                       f"{root}/other", on_batch=fails)
    assert key(failing) == key(batch)


def test_streaming_quota_counts_what_came_too_late(spark):
    import tempfile

    from quarry.streaming import incremental as SM
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    at = lambda h: f"2024-01-01 {h:02d}:30:00"
    for name, hours in (("a", [1, 20]), ("b", [2, 20])):  # the second file's first line is 18 hours late
        df = spark.createDataFrame([("ip", at(h)) for h in hours], "ip string, t string").select(
            "ip", F.to_timestamp("t").alias("ts"))
        df.coalesce(1).write.parquet(f"{root}/in/{name}")
        schema = df.schema
        table, late = SM.streaming_quota(spark, f"{root}/in/*", schema, root, "ip", "ts", "1 hour", "2 hours", cap=1)
    rows = {r["window_start"].hour: (r["hits"], r["over"]) for r in SM.read_latest(spark, table, ["ip", "window_start"]).collect()}
    assert rows == {1: (1, False), 20: (2, True)} and late == 1
