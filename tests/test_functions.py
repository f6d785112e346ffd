"""Scalar goldens: percentage rounding, JSON casts, link groups, keys, headers."""

from pyspark.sql import functions as F

from quarry.functions import keys as K
from quarry.functions.scalars import first_digits_int, json_int, links, percentage
from quarry.operators import requests as RQ


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_percentage_goldens(spark):
    assert one(spark, percentage(F.lit(1800), F.lit(12000))) == 15.0
    assert one(spark, percentage(F.lit(2500), F.lit(15000), 1)) == 16.7
    assert one(spark, percentage(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, percentage(F.lit(5), F.lit(0))) == 0.0


def test_json_int_rounds_like_try_cast(spark):
    assert one(spark, json_int(F.lit("86.6"))) == 87
    assert one(spark, json_int(F.lit("-86.6"))) == -87
    assert one(spark, json_int(F.lit("x"))) is None
    assert one(spark, first_digits_int(F.lit("+12% (augmented)"))) == 12
    assert one(spark, first_digits_int(F.lit("none"))) is None


def test_links_counts_largest_group_with_null_group(spark):
    assert one(spark, links(F.lit('[{"group":0},{"group":0},{"group":1}]'))) == 2
    assert one(spark, links(F.lit('[{"x":1},{"x":2},{"group":1}]'))) == 2
    assert one(spark, links(F.lit("[]"))) == 0
    assert one(spark, links(F.lit(None).cast("string"))) == 0


def test_key_roundtrip_and_classify(spark):
    key = K.snapshot_state_key(F.lit("Mirage (PL1)"), F.lit("s1"))
    assert one(spark, key) == "state/Mirage%20(PL1)/snapshots/s1.ndjson.gz"
    df = spark.createDataFrame([(k,) for k in [
        "index.json", "economy/Mirage.json", "raw/Mirage/s1/a.json", "state/tree/3.1.json",
        "state/Mirage/roster.json", "state/Mirage/snapshots/s1.ndjson.gz",
        "state/Mirage/results/s1/w01.ndjson.gz", "state/Mirage/chunks/s1/00001.json",
        "state/Mirage/workers/w1.json", "state/Mirage/ips/1.json", "state/Mirage/current.json",
        "snapshots/Mirage/s1/detail/items.parquet", "snapshots/Mirage/s1/agg/x.json",
        "snapshots/Mirage/s1/meta.json", "misc/x"]], "key string")
    cats = [r[0] for r in df.select(K.classify_key("key")).collect()]
    assert cats == K.CATEGORIES
    league, snap = K.parse_any(F.lit("state/Hardcore%20Mirage/results/s9/w00.ndjson.gz"))
    assert one(spark, league) == "Hardcore Mirage" and one(spark, snap) == "s9"
    assert one(spark, K.decode_segment(F.lit("a+b%ZZ"))) == "a+b%ZZ"
    assert one(spark, K.pad(F.lit(123), 2)) == "123"


def test_rate_headers_and_windows(spark):
    tuples = RQ.parse_tuples(F.lit("30:60:60, 90:1800:120,0:5:5,,x:10:0,180:7200:600"))
    got = one(spark, tuples)
    assert [(t["hits"], t["periodSec"], t["penaltySec"]) for t in got] == \
        [(30, 60, 60), (90, 1800, 120), (180, 7200, 600)]
    headers = F.create_map(F.lit("x-rate-limit-rules"), F.lit("Ip"),
                           F.lit("x-rate-limit-ip"), F.lit("30:60:60,90:1800:120,180:7200:600"))
    wins = one(spark, RQ.windows_of(RQ.rate_rules(headers)))
    assert [w["cap"] for w in wins] == [27, 81, 162]
    assert [w["period_ms"] for w in wins] == [60000, 1800000, 7200000]


def test_retry_after(spark):
    now = F.lit("2015-10-21T07:27:00").cast("timestamp")
    h = F.create_map(F.lit("retry-after"), F.lit("30"))
    assert one(spark, RQ.retry_after_ms(h, now)) == 30000
    h = F.create_map(F.lit("retry-after"), F.lit("Wed, 21 Oct 2015 07:28:00 GMT"))
    assert one(spark, RQ.retry_after_ms(h, now)) == 60000
    h = F.create_map(F.lit("retry-after"), F.lit("Wed, 21 Oct 2015 07:20:00 GMT"))
    assert one(spark, RQ.retry_after_ms(h, now)) is None
