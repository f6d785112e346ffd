"""Document sources on hand-written folders."""

import json
import os
import tempfile

import pytest

from quarry.sources import documents as D


def _put(root, key, text):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def manifest(**over):
    m = {"schemaVersion": 6, "snapshotId": "s1", "league": "Mirage", "phase": "collecting",
         "ladderCapturedAt": "2024-01-01T00:00:00.000Z", "totalCharacters": 8,
         "outcomes": {"pending": 8, "ok": 0, "private": 0, "retryable": 0, "dead": 0, "skipped": 0}}
    m.update(over)
    return json.dumps(m)


def test_inventory_and_manifests(spark):
    root = tempfile.mkdtemp(prefix="quarry-docs-")
    _put(root, "state/Mirage/current.json", manifest())
    _put(root, "state/Hardcore%20Mirage/current.json", manifest(league="Hardcore Mirage", snapshotId="s2"))
    _put(root, "state/Bad/current.json", "{not json")
    _put(root, "state/Num/current.json", manifest(snapshotId=7))
    _put(root, "state/Old/current.json", manifest(schemaVersion=5))
    inv = {r["key"]: r["size"] for r in D.scan_inventory(spark, root).collect()}
    assert inv["state/Mirage/current.json"] == len(manifest())
    assert len(inv) == 5 and "state/Hardcore%20Mirage/current.json" in inv
    got = sorted((r["league"], r["snapshotId"], r["outcomes"]["pending"])
                 for r in D.scan_manifests(spark, f"{root}/state/*/current.json").collect())
    assert got == [("Hardcore Mirage", "s2", 8), ("Mirage", "s1", 8)]
    assert D.scan_manifests(spark, f"{root}/nothing/*.json").count() == 0


def test_roster_absent_corrupt_foreign(spark):
    root = tempfile.mkdtemp(prefix="quarry-docs-")
    row = {"account": "a", "character": "A", "class": "X", "level": 1, "rank": 1,
           "firstSeenAt": "t", "lastSeenAt": "t"}
    _put(root, "ok/roster.json", json.dumps({"schemaVersion": 6, "characters": [row, row]}))
    _put(root, "old/roster.json", json.dumps({"schemaVersion": 5, "characters": [row]}))
    _put(root, "bad/roster.json", "{")
    assert D.scan_roster(spark, f"{root}/ok/roster.json").count() == 2
    assert D.scan_roster(spark, f"{root}/old/roster.json").count() == 0
    assert D.scan_roster(spark, f"{root}/bad/roster.json").count() == 0
    assert D.scan_roster(spark, f"{root}/none/roster.json").count() == 0


def test_leagues_array_or_error(spark):
    root = tempfile.mkdtemp(prefix="quarry-docs-")
    _put(root, "leagues.json", json.dumps([{"id": "Mirage", "category_id": "m", "start_at": "x"},
                                           {"id": "Standard"}]))
    _put(root, "bad.json", json.dumps({"id": "x"}))
    rows = D.scan_leagues(spark, f"{root}/leagues.json").orderBy("pos").collect()
    assert [(r["id"], r["pos"]) for r in rows] == [("Mirage", 0), ("Standard", 1)]
    with pytest.raises(Exception):
        D.scan_leagues(spark, f"{root}/bad.json").collect()


def test_catalogue_and_meta(spark):
    root = tempfile.mkdtemp(prefix="quarry-docs-")
    idx = {"schemaVersion": 6, "updatedAt": "t", "leagues": [
        {"league": "Mirage", "snapshots": [
            {"schemaVersion": 6, "snapshotId": "s1", "hasDetail": True, "extra": {"k": 1}},
            {"schemaVersion": 4, "snapshotId": "s0", "hasDetail": False}]}]}
    _put(root, "index.json", json.dumps(idx))
    rows = sorted((r["league"], r["snapshotId"], r["schemaVersion"], r["hasDetail"])
                  for r in D.scan_catalogue(spark, f"{root}/index.json").collect())
    assert rows == [("Mirage", "s0", 4, False), ("Mirage", "s1", 6, True)]
    entry = [r["entry"] for r in D.scan_catalogue(spark, f"{root}/index.json").collect()
             if '"s1"' in r["entry"]][0]
    assert json.loads(entry)["extra"] == {"k": 1}
    _put(root, "bad/index.json", "[")
    assert D.scan_catalogue(spark, f"{root}/bad/index.json").count() == 0
    _put(root, "snapshots/Hardcore%20Mirage/s1/meta.json",
         json.dumps({"completedAt": "2024-01-02T00:00:00.000Z", "updatedAt": "u"}))
    _put(root, "snapshots/Mirage/s2/meta.json", "{oops")
    meta = {(r["league"], r["snapshot_id"]): (r["completedAt"], r["updatedAt"])
            for r in D.scan_meta(spark, f"{root}/snapshots/*/*/meta.json").collect()}
    assert meta == {("Hardcore Mirage", "s1"): ("2024-01-02T00:00:00.000Z", "u"),
                    ("Mirage", "s2"): (None, None)}
