"""Economy documents (S18 + V4), catalogue write (S22), cluster map."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import economy as EC
from quarry.operators import normalize as N
from quarry.sources import sinks


def test_economy_written_only_for_complete_leagues(spark):
    leagues = spark.createDataFrame([("Mirage",), ("Standard",)], "id string")
    rows = [("Mirage", ep, t, 200, 1, i) for i, (ep, t) in enumerate(EC.CATALOGUE_PAIRS)]
    rows += [("Standard", ep, t, 200, 1, i) for i, (ep, t) in enumerate(EC.CATALOGUE_PAIRS[:-1])]
    rows += [("Standard", *EC.CATALOGUE_PAIRS[-1], 503, 2, 99)]
    resp = spark.createDataFrame(rows, "league string, endpoint string, type string, status int, "
                                       "ts long, seq long")
    report = EC.economy_league_report(EC.economy_completeness(leagues, resp))
    got = {r["league"]: (r["categories_fetched"], r["written"], [f["reason"] for f in r["failures"]])
           for r in report.collect()}
    assert got["Mirage"] == (43, True, [])
    assert got["Standard"] == (42, False, ["server error (503)"])
    ok = EC.publish_complete_leagues(report).select("league")
    bodies = resp.join(ok, "league", "left_semi").select(
        "league", "endpoint", "type",
        F.to_json(F.struct(F.col("seq").alias("n"))).alias("body"))
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-econ-"), "economy")
    sinks.write_economy(bodies, out)
    written = sorted(d for d in os.listdir(out) if d.startswith("league="))
    assert written == ["league=Mirage"]
    doc = spark.read.json(out).first()
    assert len(doc["categories"]["exchange"]) == 16


def test_write_catalogue_stamps_updated_at(spark):
    cat = spark.createDataFrame([("Mirage", "s1", True)], "league string, snapshot_id string, hasDetail boolean")
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-cat-"), "catalogue")
    sinks.write_catalogue(cat, out, "2024-01-02T00:00:00.000Z")
    sinks.write_catalogue(cat, out, "2024-01-03T00:00:00.000Z")  # replaces the table
    sinks.write_catalogue(sinks.read_catalogue(spark, out), out, "2024-01-03T00:00:00.000Z")  # from itself
    rows = sinks.read_catalogue(spark, out).collect()
    assert [(r["snapshot_id"], r["updatedAt"]) for r in rows] == [("s1", "2024-01-03T00:00:00.000Z")]


def test_cluster_map_rows(spark):
    passives = {"hashes": [], "hashes_ex": [7], "jewel_data": {
        "1": {"subgraph": {"nodes": {"7": {"name": "A", "isNotable": True}, "x": {"name": "bad key"}}}},
        "2": {"subgraph": {"nodes": {"7": {"name": "B"}}}}}}
    line = {"ordinal": 0, "rank": 1, "account": "a", "character": "A", "outcome": "ok", "attempts": 1,
            "fetchedAt": "t", "characterData": json.dumps({"items": []}), "passiveTree": json.dumps(passives)}
    state = spark.createDataFrame([line], schemas.STATE_LINE)
    parsed = N.parse_payloads(N.latest_per_identity(N.ok_records(state)))
    got = sorted(((r["node_hash"], r["node"]["name"]) for r in N.cluster_map(parsed).collect()),
                 key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert got == [(7, "A"), (7, "B"), (None, "bad key")]  # a non-numeric key never matches
