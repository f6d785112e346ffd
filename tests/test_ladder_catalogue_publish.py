"""Ladder stitching (S11/S12), catalogue ops (J10/O4), F12/F18, staged publish (V3)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions.scalars import snapshot_id
from quarry.operators import economy as EC
from quarry.operators import roster as RO
from quarry.operators import storage as SO
from quarry.plans import snapshot
from quarry.sources import sinks


def page(total, names, drop=()):
    entries = []
    for i, n in enumerate(names):
        e = {"rank": i + 1, "character": {"name": n, "level": 90}, "account": {"name": "acc-" + n}}
        if n in drop:
            del e["account"]
        entries.append(e)
    return json.dumps({"total": total, "entries": entries})


def test_ladder_window_stops_and_voids(spark):
    rows = [
        ("a", 0, page(5, ["a1", "a2"])), ("a", 2, page(5, ["a3", "a4"])), ("a", 4, page(5, ["a5"])),
        ("b", 0, page(3, ["b1", "b2", "b3"])),            # total reached after the first page
        ("c", 0, page(9, ["c1", "c2"])), ("c", 4, page(9, ["c5"])),   # page 2 missing -> void
        ("d", 0, page(9, ["d1", "d2"], drop=("d2",))), ("d", 2, json.dumps({"total": 9})),  # malformed
        ("e", 0, page(9, ["e1", "e2"])), ("e", 2, page(9, [])),       # empty page stops
    ]
    pages = spark.createDataFrame(rows, "capture string, offset long, doc string")
    got = RO.ladder_window(pages, depth=6, page_size=2, by=["capture"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["capture"], []).append((r["offset"], r["pos"], r["character"], r["class"]))
    assert sorted(by) == ["a", "b", "e"]
    assert [c for _, _, c, _ in sorted(by["a"])] == ["a1", "a2", "a3", "a4", "a5"]
    assert [c for _, _, c, _ in sorted(by["b"])] == ["b1", "b2", "b3"]
    assert all(cls == "Unknown" for _, _, _, cls in by["e"])


def test_catalogue_upsert_trim_order(spark):
    cat = spark.createDataFrame([
        ("Mirage", "s1", "2024-01-01", 6, True, False), ("Mirage", "s0", "2023-12-01", 4, True, False),
        ("Zed", "z1", "2024-01-01", 6, True, False)],
        "league string, snapshot_id string, ladderCapturedAt string, schemaVersion int, "
        "hasDetail boolean, is_new boolean")
    new = spark.createDataFrame([("Mirage", "s1", "2024-01-01", 6, True, True)], cat.schema)
    up = SO.catalogue_upsert(cat, new)
    assert up.count() == 3 and up.where("is_new").count() == 1
    trimmed = spark.createDataFrame([("Mirage", "s0")], "league string, snapshot_id string")
    marked = SO.mark_trimmed(up, trimmed)
    assert {r["snapshot_id"]: r["hasDetail"] for r in marked.collect()}["s0"] is False
    order = [r["snapshot_id"] for r in SO.order_catalogue(marked).orderBy("position").collect()]
    assert order == ["s1", "z1", "s0"]
    assert SO.catalogue_remove(marked, trimmed).count() == 2


def test_snapshot_id_and_economy_backoff(spark):
    row = spark.range(1).select(
        snapshot_id(F.lit("2024-01-02T03:04:05.678Z")).alias("id"),
        EC.economy_backoff_ms(F.lit(429), F.lit(1), F.lit("120")).alias("a"),
        EC.economy_backoff_ms(F.lit(429), F.lit(2), F.lit(None).cast("string")).alias("b"),
        EC.economy_backoff_ms(F.lit(503), F.lit(3), F.lit("5")).alias("c"),
        EC.economy_backoff_ms(F.lit(404), F.lit(0), F.lit("5")).alias("d")).first()
    assert row["id"] == "2024-01-02T03-04-05-678Z"
    assert (row["a"], row["b"], row["c"], row["d"]) == (60000, 4000, 8000, None)


def _line(acct, cls, outcome="ok"):
    items = {"character": {"class": cls}, "items": [{"inventoryId": "Weapon", "typeLine": "Sword"}]}
    return {"ordinal": 0, "rank": 1, "account": acct, "character": acct.upper(), "class": cls,
            "level": 1, "outcome": outcome, "attempts": 1, "fetchedAt": "2024-01-01T00:00:00.000Z",
            "characterData": json.dumps(items) if outcome == "ok" else None,
            "passiveTree": json.dumps({"hashes": [1]}) if outcome == "ok" else None}


def test_publish_only_after_gate(spark):
    tree = spark.createDataFrame([(1, "n", [], False)], schemas.TREE_NODE)
    lines = [dict(_line("a", "X"), ordinal=0), dict(_line("b", "Y"), ordinal=1),
             dict(_line("c", "Y", outcome="pending"), ordinal=2)]
    state = spark.createDataFrame(lines, schemas.STATE_LINE)
    root = tempfile.mkdtemp(prefix="quarry-publish-")
    good = os.path.join(root, "good")
    gate = sinks.publish_snapshot(snapshot.normalise(state, tree, "s"), sinks.tally_for(state),
                                  good, "Mirage", "2024-01-01T00:00:00.000Z")
    assert gate["ok_to_publish"], gate["errors"]
    assert spark.read.parquet(f"{sinks.current(spark, good)}/detail/characters").count() == 2
    # A tally that disagrees with the rows (coverage mismatch) blocks the publish.
    bad_tally = sinks.tally_for(state.withColumn("outcome", F.lit("pending")))
    bad = os.path.join(root, "bad")
    gate = sinks.publish_snapshot(snapshot.normalise(state, tree, "s"), bad_tally, bad,
                                  "Mirage", "2024-01-01T00:00:00.000Z")
    assert not gate["ok_to_publish"] and not os.path.exists(bad)


def test_incremental_then_final(spark):
    tree = spark.createDataFrame([(1, "n", [], False)], schemas.TREE_NODE)

    def state(outcomes):
        rows = [dict(_line(f"c{i}", "X" if i % 2 else "Y", outcome=o), ordinal=i)
                for i, o in enumerate(outcomes)]
        return spark.createDataFrame(rows, schemas.STATE_LINE)

    root = tempfile.mkdtemp(prefix="quarry-publish-")
    path = os.path.join(root, "snap")
    s1 = state(["ok"] * 3 + ["pending"] * 4 + ["private"])
    g1 = sinks.publish_snapshot(snapshot.normalise(s1, tree, "s"), sinks.tally_for(s1), path,
                                "Mirage", "t0", now="t1")
    assert g1["ok_to_publish"] and g1["complete"] is False
    m1 = spark.read.json(f"{sinks.current(spark, path)}/meta").first()
    assert (m1["pendingCount"], m1["totalCharacters"], m1["coverage"]["ok"]) == (4, 8, 3)
    assert "completedAt" not in m1.asDict()
    s2 = state(["ok"] * 5 + ["private"] + ["dead"] * 2)
    assert sinks.final_publish(snapshot.normalise(s1, tree, "s"), sinks.tally_for(s1), path,
                               "Mirage", "t0", "t2")["ok_to_publish"] is False
    g2 = sinks.publish_snapshot(snapshot.normalise(s2, tree, "s"), sinks.tally_for(s2), path,
                                "Mirage", "t0", now="t2")
    assert g2["ok_to_publish"] and g2["complete"] is True
    m2 = spark.read.json(f"{sinks.current(spark, path)}/meta").first()
    assert (m2["completedAt"], m2["characterCount"]) == ("t2", 5)
    final = os.path.join(root, "final")
    assert sinks.final_publish(snapshot.normalise(s2, tree, "s"), sinks.tally_for(s2), final,
                               "Mirage", "t0", "t3")["ok_to_publish"]
    import pytest
    with pytest.raises(FileExistsError):
        sinks.final_publish(snapshot.normalise(s2, tree, "s"), sinks.tally_for(s2), final,
                            "Mirage", "t0", "t4")
