"""One JSON document cut by many byte ranges equals the document parsed whole."""

import json
import random

import pytest

from quarry.sources import documents as D
from quarry.sources import splitter


@pytest.fixture
def tiny_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def ranges(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    yield ranges
    for k, v in old.items():
        spark.conf.set(k, v)


def put(tmp_path, text):
    path = tmp_path / "document.json"
    path.write_text(text, encoding="utf-8")
    return str(path)


def nasty(rng):
    word = lambda: "".join(rng.choice('ab"\\{}[],:é \n中/') for _ in range(rng.randrange(12)))
    return rng.choice([{"n": word(), "k": [word(), {"x": [1, {"y": word()}]}]}, word(), [], {}, [[], [word()]], 1.5, None, True, {"}": "]"}])


@pytest.mark.parametrize(("size", "indent"), [(5_003, None), (7_001, 2), (100_000, None)])
def test_elements_equal_the_parsed_document(spark, tmp_path, tiny_ranges, size, indent):
    rng = random.Random(size)
    document = {"a": {"deep": [nasty(rng)]}, "empty": [], "rows": [nasty(rng) for _ in range(900)], "note": 'x"[,]}\\', "more": [nasty(rng), [nasty(rng)]], "z": {}}
    path = put(tmp_path, json.dumps(document, ensure_ascii=False, indent=indent) + ("\n" if indent else ""))
    tiny_ranges(size)
    skeleton, cut = splitter.elements(spark, path, 2)
    assert json.loads(skeleton) == {k: [] if isinstance(v, list) else v for k, v in document.items()}
    places = list(splitter.arrays_at(json.loads(skeleton), 2))
    assert places == [("empty",), ("rows",), ("more",)]
    got = sorted((r.array, r.pos, json.dumps(json.loads(r.text))) for r in cut.collect())
    assert [(a, t) for a, _, t in got] == [(a, json.dumps(x)) for a, name in ((1, "rows"), (2, "more")) for x in document[name]]
    skeleton, cut = splitter.elements(spark, path, 3)
    assert list(splitter.arrays_at(json.loads(skeleton), 3))[0] == ("a", "deep")


@pytest.mark.parametrize("text", ["", " ", "{", '{"rows":[1,,2]}', '{"rows":[1,]}', '{"rows":[1}', '{"rows":[{"a":1]}]}', '{"rows":["open]}', '{"rows":[1]]}', '{"rows":[tru]}'])
def test_malformed_documents_are_none(spark, tmp_path, tiny_ranges, text):
    assert splitter.elements(spark, put(tmp_path, text), 2) == (None, None)


def test_damage_in_one_of_many_ranges(spark, tmp_path, tiny_ranges):
    tiny_ranges(8_000)
    text = json.dumps({"rows": [{"n": i, "t": "}" * 9} for i in range(900)]})
    assert splitter.elements(spark, put(tmp_path, text), 2)[1].count() == 900
    assert splitter.elements(spark, put(tmp_path, text.replace('"n": 555', '"n" 555')), 2) == (None, None)


def test_missing_document_and_scans_over_ranges(spark, tmp_path, tiny_ranges):
    assert splitter.elements(spark, str(tmp_path / "none.json"), 2) == (None, None)
    row = {"account": "ä}{", "character": 'q"\\', "class": "X", "level": 1, "rank": 0, "firstSeenAt": "t", "lastSeenAt": "t"}
    tiny_ranges(6_000)
    roster = put(tmp_path, json.dumps({"characters": [row | {"rank": i} for i in range(300)], "schemaVersion": 6, "tags": [1, 2]}))
    assert sorted(r["rank"] for r in D.scan_roster(spark, roster).collect()) == list(range(300))
    assert {r["character"] for r in D.scan_roster(spark, roster).collect()} == {'q"\\'}
    leagues = put(tmp_path, json.dumps([{"id": f"L{i}"} for i in range(900)]))
    assert [(r["pos"], r["id"]) for r in D.scan_leagues(spark, leagues).orderBy("pos").collect()] == [(i, f"L{i}") for i in range(900)]
    index = put(tmp_path, json.dumps({"schemaVersion": 6, "leagues": [
        {"league": f"l{i}", "tags": [], "snapshots": [{"snapshotId": f"s{i}-{k}", "own": {"k": [k]}} for k in range(i)]} for i in range(25)]}, indent=1))
    got = sorted((r["league"], r["snapshot_id"], json.loads(r["entry"])["own"]["k"][0]) for r in D.scan_catalogue(spark, index).collect())
    assert got == sorted((f"l{i}", f"s{i}-{k}", k) for i in range(25) for k in range(i))
