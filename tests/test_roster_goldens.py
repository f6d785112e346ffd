"""Roster goldens from the reference's test strategy (hand-made fixtures)."""

from quarry.operators import roster as RO

ROSTER_T = ("account string, character string, class string, level int, rank int, "
            "firstSeenAt string, lastSeenAt string")
ENTRY_T = "offset long, pos int, rank int, account string, character string, class string, level int"


def capture(spark, *entries):
    rows = [(i, 0, rank, acct, ch, "Juggernaut", level) for i, (rank, acct, ch, level) in enumerate(entries)]
    return spark.createDataFrame(rows, ENTRY_T)


def test_append_and_refresh(spark):
    t0, t1 = "2026-07-01T00:00:00.000Z", "2026-07-02T00:00:00.000Z"
    empty = spark.createDataFrame([], ROSTER_T)
    first, c1 = RO.merge_ladder(empty, capture(spark, (1, "a", "A", 90), (2, "b", "B", 90)), t0)
    assert tuple(c1.first()) == (2, 0)
    nxt, c2 = RO.merge_ladder(first, capture(spark, (1, "c", "C", 100), (2, "a", "A", 95)), t1)
    assert tuple(c2.first()) == (1, 1)
    rows = {r["account"]: r for r in nxt.collect()}
    assert len(rows) == 3
    a, b = rows["a"], rows["b"]
    assert (a["rank"], a["level"], a["firstSeenAt"], a["lastSeenAt"]) == (2, 95, t0, t1)
    # leaving the ladder never evicts: b keeps its last seen facts
    assert (b["rank"], b["level"], b["firstSeenAt"], b["lastSeenAt"]) == (2, 90, t0, t0)


def test_order_by_last_seen_rank_with_stable_ties(spark):
    t0 = "2026-07-01T00:00:00.000Z"
    empty = spark.createDataFrame([], ROSTER_T)
    first, _ = RO.merge_ladder(empty, capture(spark, (3, "a", "A", 90), (2, "b", "B", 90)), t0)
    nxt, _ = RO.merge_ladder(first, capture(spark, (1, "c", "C", 90), (2, "a", "A", 90)), t0)
    assert [r["account"] for r in RO.order_roster(nxt).collect()] == ["c", "a", "b"]


def test_same_name_on_two_accounts_is_two_characters(spark):
    empty = spark.createDataFrame([], ROSTER_T)
    _, counts = RO.merge_ladder(empty, capture(spark, (1, "a", "Twin", 90), (2, "b", "Twin", 90)), "t")
    assert tuple(counts.first()) == (2, 0)
