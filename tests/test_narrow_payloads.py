"""A table parses the payload fields that it reads, and skills an item's sockets once."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import normalize as N
from quarry.plans import snapshot

GEM = {"socket": 1, "support": False, "typeLine": "Slam", "properties": [{"name": "Level", "values": [["20 (Max)", "0"]]}]}
ITEM = {"inventoryId": "Weapon", "name": "w", "typeLine": "Axe", "ilvl": 7, "sockets": [{"group": 0}, {"group": 4}, {"group": 4}],
        "explicitMods": ["m"], "socketedItems": [GEM, {**GEM, "socket": 9}, {**GEM, "socket": 2, "support": True, "typeLine": "Help"}]}
TREE = {"hashes": [1, 2], "hashes_ex": [7], "mastery_effects": {"5": 6}, "items": [{"inventoryId": "PassiveJewels", "name": "j"}],
        "jewel_data": {"0": {"subgraph": {"nodes": {"7": {"name": "n"}}}}}}
PAYLOADS = [
    (json.dumps({"character": {"class": "c", "classId": 2}, "items": [ITEM]}), json.dumps(TREE)),
    # Fields of the wrong kind, text cut short, repeated keys, nulls.
    (json.dumps({"character": 5, "items": [{**ITEM, "explicitMods": "m", "properties": 3}, 4, None]}), json.dumps({**TREE, "hashes": "x"})),
    (json.dumps({"items": [{**ITEM, "sockets": "text", "socketedItems": {"a": 1}}]}), json.dumps({**TREE, "jewel_data": [1], "items": {}})),
    (json.dumps({"items": [ITEM], "character": {"class": "c"}})[:-9], json.dumps(TREE)[:-3]),
    ('{"items":[],"items":[{"inventoryId":"Ring","ilvl":1,"ilvl":"2"}]}', '{"mastery_effects":{"1":2,"1":3}}'),
    (None, None), ("", "[]"), ("[1]", "null"),
]
TABLES = ["characters", "items", "item_mods", "skills", "passives", "masteries"]


@pytest.fixture(scope="module")
def norm(spark):
    rows = [(i, i, "a", str(i), "c", 1, "t", *p) for i, p in enumerate(PAYLOADS)]
    latest = spark.createDataFrame(rows, schemas.RAW_CHAR).withColumn("character_key", F.concat_ws("/", "account", "character"))
    tree = spark.createDataFrame([(1, "k", ["s"], True)], schemas.TREE_NODE)
    return snapshot.of_characters(latest, tree)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", TABLES)
def test_tables_are_those_of_whole_payloads(norm, name):
    whole = snapshot.Normalised(norm.chars, norm.item_rows, norm.tree, norm.snapshot_id)
    assert _rows(norm.table(name)) == _rows(whole.table(name))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _read(df):
    """The fields in the schemas of the parsed texts."""
    nodes = df._jdf.queryExecution().optimizedPlan()
    return {f for f in ("explicitMods", "socketedItems", "jewel_data", "hashes_ex", "mastery_effects", "requirements", "classId")
            if f"StructField({f}," in nodes.toString()}


def test_only_fields_read_are_parsed(norm):
    assert _read(norm.table("skills")) == {"socketedItems"}
    assert _read(norm.table("items")) == {"requirements"}
    assert _read(norm.table("item_mods")) == {"explicitMods"}
    assert _read(norm.table("characters")) == {"classId"}
    assert _read(norm.table("passives")) == {"hashes_ex", "jewel_data"}
    assert _read(norm.table("masteries")) == {"mastery_effects"}


def test_sockets_are_parsed_below_the_explode(norm):
    plan = _plan(norm.table("skills"))
    above, below = plan.split("Generate explode(gems", 1)
    assert "from_json" not in above and "StructField(group," in below
    got = {(r["link_group"], r["gem"], tuple(r["supports"])) for r in norm.table("skills").collect() if r["character_key"] == "a/0"}
    assert got == {(4, "Slam", ("Help",)), (None, "Slam", ())}  # socket 9 is none


def test_written_items_are_read(norm):
    import dataclasses
    written = dataclasses.replace(norm, item_rows=norm.item_rows.where(F.lit(False)), items_written=True)
    assert written.table("skills").count() == 0 and norm.table("skills").count() > 0
