"""The streamed quota audit: several caps, lines that wait, restarts, late lines."""

import random

from pyspark.sql import functions as F

from quarry.operators import requests as RQ
from quarry.session import checkpoint_root
from quarry.streaming import pacing

HOUR = 3_600_000
START = 1_700_000_000_000


def test_lines_equal_a_plain_audit():
    rng = random.Random(3)
    lines = sorted([rng.randrange(60_000), k, [[2, 5_000], [5, 20_000]]] for k in range(300))
    got = pacing.audit_lines([x[0] for x in lines[:100]], lines[100:], 60_000)
    times = [x[0] for x in lines]
    for seq, ts, cap, period, hits, violation, earliest in got:
        at = next(i for i, x in enumerate(lines) if x[1] == seq)
        assert hits == sum(ts - period < t <= ts for t in times)
        assert violation == (times[at - cap] + period > ts) and earliest == (times[at - cap] + period if violation else None)
    assert len(got) == 400


def test_a_restarted_stream_goes_on_with_its_state(spark):
    root = checkpoint_root(spark, "pacing-test", unique=True)

    def put(*rows):
        df = spark.createDataFrame([(ip, seq, START + ms) for ip, seq, ms in rows], "ip string, seq long, ts_ms long")
        df.select("ip", "seq", F.timestamp_millis("ts_ms").alias("ts"), "ts_ms", F.create_map(
            F.lit("x-rate-limit-rules"), F.lit("Ip"), F.lit("x-rate-limit-ip"), F.lit("2:60:10,3:600:10")).alias("headers")) \
            .coalesce(1).write.mode("append").parquet(f"{root}/log")
        return spark.read.parquet(f"{root}/log")
    rows = [("a", 1, 0), ("a", 2, 10_000), ("b", 3, 20_000), ("a", 5, 50_000), ("a", 4, 40_000), ("a", 6, 2 * HOUR), ("b", 7, 2 * HOUR)]
    schema = put(*rows[:4]).schema
    run = lambda: pacing.streaming_caps(spark, f"{root}/log", schema, f"{root}/out", HOUR, "1 minute")
    run()
    put(*rows[4:])
    run()
    put(("a", 8, 3 * HOUR - 1), ("end", 9, 9 * HOUR))
    run()
    put(("a", 10, 4 * HOUR))  # long passed by the watermark
    got = {tuple(r) for r in run().drop("batch").where("ip <> 'end'").collect()}
    log = spark.createDataFrame([(ip, seq, START + ms) for ip, seq, ms in (*rows, ("a", 8, 3 * HOUR - 1))], "ip string, seq long, ts_ms long")
    want = RQ.quota_audit(log, [(1, 60_000), (2, 600_000)]).select("ip", "seq", "ts_ms", "cap", "period_ms", "hits", "violation", "earliest_ms")
    want = {tuple(r) for r in want.collect()}
    assert (got - want, want - got) == (set(), set())
