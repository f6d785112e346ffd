"""Merge, seed, roster, retention, leagues: goldens and properties."""

from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import economy as EC
from quarry.operators import roster as RO
from quarry.operators import state as ST
from quarry.operators import storage as SO
from quarry.operators.common import with_global_ordinal


def test_global_ordinal_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    out = with_global_ordinal(df, [F.col("k").desc(), "id"], partitions=7)
    rows = out.orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(1000))
    assert [r["k"] for r in rows] == sorted((r["k"] for r in rows), reverse=True)


def _state(spark, rows):
    full = [dict(ordinal=i, rank=i, account=a, character=c, outcome=o, attempts=n)
            for i, (a, c, o, n) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.STATE_LINE)


def test_merge_last_write_wins_and_idempotent(spark):
    state = _state(spark, [("a", "A", "pending", 0), ("b", "B", "pending", 0)])
    res = spark.createDataFrame(
        [("a", "A", "retryable", 1, "w00", 1), ("a", "A", "ok", 2, "w00", 2),
         ("z", "Z", "ok", 1, "w01", 1)],
        "account string, character string, outcome string, attempts int, file string, seq long")
    once = ST.merge_results(state, res)
    twice = ST.merge_results(once, res)
    got = {(r["account"], r["outcome"], r["attempts"]) for r in twice.collect()}
    assert got == {("a", "ok", 2), ("b", "pending", 0)}
    assert sorted(r["ordinal"] for r in once.collect()) == [0, 1]


def test_assign_is_disjoint_and_complete(spark):
    state = _state(spark, [(f"a{i}", "x", "pending", 0) for i in range(50)])
    slots = ST.assign(ST.pending_identities(state), 15).groupBy("slot").count().collect()
    assert sum(r["count"] for r in slots) == 50 and len(slots) == 15


def test_next_outcome_policy(spark):
    df = spark.createDataFrame([
        ("pending", 0, "ok", "ok"), ("pending", 0, "private", None), ("retryable", 2, "retryable", None),
        ("pending", 0, "rate_limited", None), ("pending", 0, "ok", "dead")],
        "outcome string, attempts int, items_kind string, passives_kind string")
    got = [(r["next_outcome"], r["next_attempts"]) for r in ST.next_outcome(df, 3).collect()]
    assert got == [("ok", 1), ("private", 1), ("dead", 3), ("pending", 0), ("dead", 1)]


def test_roster_recapture(spark):
    empty = spark.createDataFrame([], "account string, character string, class string, level int, "
                                      "rank int, firstSeenAt string, lastSeenAt string")
    e1 = spark.createDataFrame([(0, 0, "a", "A", "X", 1, 2), (1, 0, "b", "B", "X", 1, 1)],
                               "offset long, pos int, account string, character string, class string, "
                               "level int, rank int")
    r1, _ = RO.merge_ladder(empty, e1, "t1")
    e2 = spark.createDataFrame([(0, 0, "a", "A", "Y", 2, 1), (1, 0, "c", "C", "X", 1, 1)], e1.schema)
    r2, counts = RO.merge_ladder(r1, e2, "t2")
    c = counts.first()
    assert (c["added"], c["refreshed"]) == (1, 1)
    rows = {r["account"]: r for r in r2.collect()}
    assert rows["a"]["firstSeenAt"] == "t1" and rows["a"]["lastSeenAt"] == "t2" and rows["a"]["class"] == "Y"
    order = [r["account"] for r in RO.order_roster(r2).collect()]
    assert order == ["a", "b", "c"]  # rank ties -> firstSeenAt -> key


def test_trim_plan_oldest_first_across_leagues(spark):
    snaps = spark.createDataFrame([
        ("Aleague", "a1", 200_000, 1.0), ("Zleague", "b1", 200_000, 2.0), ("Aleague", "a2", 200_000, 3.0)],
        "league string, snapshot_id string, bytes long, age_ms double")
    snaps = snaps.withColumn("protected", F.lit(False))
    plan = SO.trim_plan(snaps, F.lit(600_000), F.lit(350_000))
    trimmed = sorted((r["league"], r["snapshot_id"]) for r in plan.where("trimmed").collect())
    assert trimmed == [("Aleague", "a1"), ("Zleague", "b1")]


def test_active_leagues(spark):
    rows = spark.createDataFrame([
        ("Standard", "Standard", "2013-01-01T00:00:00Z", None, 0),
        ("Mirage", "cat1", "2024-01-01T00:00:00Z", None, 1),
        ("Hardcore Mirage", "cat1", "2024-01-01T00:00:00Z", "2025-01-01T00:00:00Z", 2),
        ("Old", "cat1", "2020-01-01T00:00:00Z", "2021-01-01T00:00:00Z", 3),
        ("Future", "cat1", "2030-01-01T00:00:00Z", None, 4),
        ("Mirage", "cat1", "2024-01-01T00:00:00Z", None, 5)],
        "id string, category_id string, start_at string, end_at string, pos int")
    got = [r["id"] for r in EC.active_leagues(rows, "2024-06-01T00:00:00Z").orderBy("position").collect()]
    assert got == ["Mirage", "Hardcore Mirage", "Standard"]
    assert len(EC.CATALOGUE_PAIRS) == 43


def test_tally_coverage_and_rollup(spark):
    from quarry.operators import aggregates as AG
    outcomes = ["ok", "ok", "pending", "private", "retryable", "dead", "skipped"]
    state = _state(spark, [(f"a{i}", "X", o, 0) for i, o in enumerate(outcomes)])
    tally = AG.tally_outcomes(state)
    assert tally.first().asDict() == {"pending": 1, "ok": 2, "private": 1, "retryable": 1, "dead": 1,
                                      "skipped": 1}
    cov = AG.coverage(tally).first()
    assert (cov["ok"], cov["private"], cov["dead"], cov["pending_of"], cov["total"]) == (2, 1, 1, 2, 7)
    rolled = AG.add_tallies(tally.unionByName(tally)).first()
    assert (rolled["ok"], rolled["skipped"]) == (4, 2)
