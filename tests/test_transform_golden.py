"""End-to-end transform golden on hand-made nested documents."""

import json

from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import aggregates as A
from quarry.operators import normalize as N
from quarry.operators import quality as Q
from quarry.plans import snapshot


def gem(socket, name, support, level=20, quality=0):
    g = {"socket": socket, "typeLine": name,
         "properties": [{"name": "Level", "values": [[f"{level} (Max)", 0]]},
                        {"name": "Quality", "values": [[f"+{quality}%", 0]]}]}
    if support is not None:
        g["support"] = support
    return g


def character(acct, name, cls, skill, unique=None, keystones=(), flasks=0, fetched="2024-01-01T00:00:00.000Z"):
    items = [{"inventoryId": "Weapon", "name": unique or "", "typeLine": "Sword",
              "rarity": "Unique" if unique else "Rare", "ilvl": 86,
              "sockets": [{"group": 0}, {"group": 0}, {"group": 0}],
              "properties": [{"name": "Quality", "values": [["+12%", 0]]}],
              "requirements": [{"name": "Level", "values": [["54", 0]]}],
              "explicitMods": ["+10 to Strength"],
              "socketedItems": [gem(0, skill, False), gem(1, "Added Fire", True), gem(2, "Onslaught", True)]}]
    for i in range(flasks):
        items.append({"inventoryId": "Flask", "typeLine": f"Flask {i}", "rarity": "Magic",
                      "utilityMods": [f"flask mod {i}"]})
    passives = {"hashes": [1, 2] + list(keystones), "hashes_ex": [],
                "mastery_effects": {"4271": 88001}}
    return {"rank": 1, "account": acct, "character": name, "class": cls, "level": 90,
            "outcome": "ok", "attempts": 1, "fetchedAt": fetched,
            "characterData": json.dumps({"character": {"class": cls, "classId": 1, "experience": 12345},
                                         "items": items}),
            "passiveTree": json.dumps(passives)}


def state_df(spark, lines):
    rows = [dict(l, ordinal=i) for i, l in enumerate(lines)]
    return spark.createDataFrame(rows, schemas.STATE_LINE)


def tree_df(spark):
    rows = [(1, "Str", ["+10 Str"], False), (2, "Dex", ["+10 Dex"], False),
            (100, "Resolute Technique", ["never crit"], True), (101, "Iron Reflexes", [], True),
            (102, "Acrobatics", [], True)]
    return spark.createDataFrame(rows, schemas.TREE_NODE)


def test_golden_aggregates_and_counts(spark):
    lines = [
        character("a", "A", "Deadeye", "Tornado Shot", unique="Brood Star", keystones=(100,)),
        character("b", "B", "Deadeye", "Tornado Shot", unique="Brood Star", keystones=(100,)),
        character("c", "C", "Juggernaut", "Cyclone", unique="Brood Star", keystones=(101,)),
        character("d", "D", "Juggernaut", "Cyclone", keystones=(102,), flasks=2),
        character("e", "E", "Necromancer", "Raise Spectre"),
        dict(character("p", "P", "Witch", "x"), outcome="private", characterData=None, passiveTree=None),
    ]
    norm = snapshot.normalise(state_df(spark, lines), tree_df(spark), "snap")
    assert norm.table("characters").count() == 5
    assert norm.table("items").count() == 7
    assert norm.table("skills").count() == 5
    aggs = {k: {r["name"]: (r["count"], r["percentage"]) for r in norm.aggregate(k).collect()}
            for k in schemas.AGGREGATE_KINDS}
    assert aggs["class_distribution"] == {"Deadeye": (2, 40.0), "Juggernaut": (2, 40.0),
                                          "Necromancer": (1, 20.0)}
    assert aggs["skill_popularity"] == {"Tornado Shot": (2, 40.0), "Cyclone": (2, 40.0),
                                        "Raise Spectre": (1, 20.0)}
    assert aggs["unique_usage"] == {"Brood Star": (3, 60.0)}
    assert aggs["keystone_usage"] == {"Resolute Technique": (2, 40.0), "Iron Reflexes": (1, 20.0),
                                      "Acrobatics": (1, 20.0)}


def test_item_details_and_ids(spark):
    lines = [character("f", "F", "Deadeye", "Cyclone", flasks=2)]
    norm = snapshot.normalise(state_df(spark, lines), tree_df(spark), "snap")
    items = {r["item_id"]: r for r in norm.table("items").collect()}
    assert set(items) == {"f/F#0", "f/F#1", "f/F#2"}
    w = items["f/F#0"]
    assert (w["quality"], w["req_level"], w["links"], w["ilvl"]) == (12, 54, 3, 86)
    assert items["f/F#1"]["sockets"] is None and items["f/F#1"]["links"] == 0
    mods = {(r["item_key"], r["mod_text"]) for r in norm.table("item_mods").collect()}
    assert ("f/F#1", "flask mod 0") in mods and ("f/F#2", "flask mod 1") in mods
    skill = norm.table("skills").first()
    assert skill["supports"] == ["Added Fire", "Onslaught"] and skill["link_count"] == 3
    assert skill["is_main"] is True
    m = norm.table("masteries").first()
    assert (m["node_hash"], m["effect_hash"]) == (4271, 88001)


def test_latest_identity_wins(spark):
    old = character("a", "A", "Deadeye", "Cyclone", fetched="2024-01-01T00:00:00.000Z")
    new = character("a", "A", "Deadeye", "Lightning Strike", fetched="2024-01-02T00:00:00.000Z")
    norm = snapshot.normalise(state_df(spark, [new, old]), tree_df(spark), "snap")
    rows = norm.aggregate("skill_popularity").collect()
    assert [(r["name"], r["percentage"]) for r in rows] == [("Lightning Strike", 100.0)]


def test_schema_contract(spark):
    norm = snapshot.normalise(state_df(spark, [character("a", "A", "D", "C")]), tree_df(spark), "s")
    for name, schema in schemas.DETAIL_TABLES.items():
        Q.assert_schema(norm.table(name), schema, name)


def test_cluster_jewel_nodes(spark):
    passives = {"hashes": [1], "hashes_ex": [7, 8, 9], "items": [
        {"inventoryId": "PassiveJewels", "name": "J", "typeLine": "Large Cluster Jewel"}],
        "jewel_data": {"26725": {"subgraph": {"nodes": {"7": {"name": "Notable", "isNotable": True,
                                                              "stats": ["a"]},
                                                        "8": {"name": "Small", "stats": []}}}},
                       "999": {"subgraph": {"nodes": {"7": {"name": "Notable again", "isNotable": True}}}}}}
    line = dict(character("j", "J", "D", "C"), passiveTree=json.dumps(passives))
    norm = snapshot.normalise(state_df(spark, [line]), tree_df(spark), "s")
    p = norm.table("passives").where(F.col("source") == "cluster").collect()
    assert sorted((r["node_hash"], r["node_name"], r["is_notable"]) for r in p) == [
        (7, "Notable", True), (7, "Notable again", True), (8, "Small", False), (9, None, False)]
    ids = {r["item_id"] for r in norm.table("items").collect()}
    assert "j/J#p0" in ids and "j/J#0" in ids


def test_tally_on_empty_input(spark):
    empty = spark.createDataFrame([], schemas.STATE_LINE)
    row = A.tally_outcomes(empty).first().asDict()
    assert row == {k: 0 for k in schemas.OUTCOMES}
