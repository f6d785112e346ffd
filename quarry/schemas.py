"""Declared schemas: input lines, parse schemas for nested payloads, and the
seven published detail tables (the output contract, checked by V2).

Inputs are never inferred. Payload leaves are parsed as STRING so the text
semantics of the source JSON survive (numbers keep their spelling, nested
objects under a STRING field come back as compact JSON text).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
B = T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------- state lines
# The outcome domain and the lifecycle phases of a snapshot.
OUTCOMES = ["pending", "ok", "private", "retryable", "dead", "skipped"]
PHASES = ["ladder_capture", "collecting", "transforming", "published", "aborted"]
IN_FLIGHT_PHASES = ["ladder_capture", "collecting", "transforming"]
LIVE_PHASES = ["collecting", "transforming"]
SCHEMA_VERSION = 6

STATE_LINE = _struct(
    ("ordinal", L), ("rank", I), ("account", S), ("character", S), ("class", S),
    ("level", I), ("outcome", S), ("attempts", I), ("fetchedAt", S),
    ("characterData", S), ("passiveTree", S),
)

# The transform input (ok lines re-shaped): payloads stay JSON text.
RAW_CHAR = _struct(
    ("ordinal", L), ("rank", I), ("account", S), ("character", S), ("class", S),
    ("level", I), ("fetchedAt", S), ("items", S), ("passives", S),
)

# ------------------------------------------------------------ payload parsing
NAMED_VALUES = T.ArrayType(_struct(("name", S), ("values", T.ArrayType(T.ArrayType(S)))))

GEM = _struct(("socket", S), ("support", S), ("typeLine", S), ("properties", NAMED_VALUES))

MOD_FIELDS = [
    # Payload field -> mod domain, in publication order.
    ("implicitMods", "implicit"),
    ("explicitMods", "explicit"),
    ("craftedMods", "crafted"),
    ("enchantMods", "enchant"),
    ("fracturedMods", "fractured"),
    ("veiledMods", "veiled"),
    ("scourgeMods", "scourge"),
    ("utilityMods", "utility"),
]

ITEM = _struct(
    ("inventoryId", S), ("name", S), ("typeLine", S), ("baseType", S), ("rarity", S),
    ("ilvl", S), ("corrupted", S), ("identified", S), ("fractured", S),
    ("synthesised", S), ("mirrored", S), ("split", S),
    ("influences", S), ("sockets", S),
    ("properties", NAMED_VALUES), ("requirements", NAMED_VALUES),
    *[(f, T.ArrayType(S)) for f, _ in MOD_FIELDS],
    ("socketedItems", T.ArrayType(GEM)),
)

SOCKETS = T.ArrayType(_struct(("group", S)))

ITEMS_DOC = _struct(
    ("character", _struct(("class", S), ("classId", S), ("ascendancyClass", S),
                          ("experience", S))),
    ("items", T.ArrayType(ITEM)),
)

CLUSTER_NODE = _struct(("name", S), ("isNotable", S), ("stats", T.ArrayType(S)))
JEWEL_SOCKET = _struct(("subgraph", _struct(("nodes", T.MapType(S, CLUSTER_NODE)))))

PASSIVES_DOC = _struct(
    ("hashes", T.ArrayType(S)),
    ("hashes_ex", T.ArrayType(S)),
    ("items", T.ArrayType(ITEM)),
    ("jewel_data", T.MapType(S, JEWEL_SOCKET)),
    ("mastery_effects", T.MapType(S, S)),
)

# ------------------------------------------------------------- tree dimension
TREE_NODE = _struct(("hash", L), ("name", S), ("stats", T.ArrayType(S)), ("is_keystone", B))

# ---------------------------------------------------------------- the 7 tables
DETAIL_TABLES: dict[str, T.StructType] = {
    "characters": _struct(
        ("character_key", S), ("snapshot_id", S), ("rank", I), ("account", S),
        ("character", S), ("class", S), ("ascendancy", S), ("class_id", I),
        ("ascendancy_class", I), ("level", I), ("experience", L), ("fetched_at", S),
    ),
    "items": _struct(
        ("character_key", S), ("item_id", S), ("slot", S), ("name", S), ("base_type", S),
        ("type_line", S), ("rarity", S), ("ilvl", I), ("corrupted", B), ("influences", S),
        ("links", I), ("quality", I), ("sockets", S), ("req_level", I), ("identified", B),
        ("fractured", B), ("synthesised", B), ("mirrored", B), ("split", B),
    ),
    "item_mods": _struct(
        ("character_key", S), ("item_key", S), ("mod_domain", S), ("mod_text", S),
    ),
    "skills": _struct(
        ("character_key", S), ("slot", S), ("link_group", I), ("gem", S), ("level", I),
        ("quality", I), ("supports", T.ArrayType(S)), ("link_count", I), ("is_main", B),
    ),
    "passives": _struct(
        ("character_key", S), ("node_hash", L), ("node_name", S),
        ("node_stats", T.ArrayType(S)), ("is_keystone", B), ("source", S), ("is_notable", B),
    ),
    "masteries": _struct(
        ("character_key", S), ("node_hash", L), ("effect_hash", L),
        ("effect_stats", T.ArrayType(S)),
    ),
    "raw": _struct(("character_key", S), ("items", S), ("passives", S)),
}

AGGREGATE_KINDS = ["class_distribution", "skill_popularity", "unique_usage", "keystone_usage"]

AGGREGATE_ROW = _struct(("kind", S), ("name", S), ("count", L), ("percentage", T.DoubleType()),
                        ("total", L))

# --------------------------------------------------------- roster & documents
ROSTER = _struct(
    ("account", S), ("character", S), ("class", S), ("level", I), ("rank", I),
    ("firstSeenAt", S), ("lastSeenAt", S),
)

LADDER_ENTRY = _struct(("rank", I), ("account", S), ("character", S), ("class", S), ("level", I))

MANIFEST = _struct(
    ("schemaVersion", I), ("snapshotId", S), ("league", S), ("depth", I), ("phase", S),
    ("ladderCapturedAt", S), ("completedAt", S), ("abortedAt", S), ("totalCharacters", I),
    ("outcomes", _struct(*[(o, I) for o in OUTCOMES])), ("transformAttempts", I),
)

INVENTORY = _struct(("key", S), ("size", L))

LEAGUE_ROW = _struct(("id", S), ("category_id", S), ("start_at", S), ("end_at", S))

RESPONSE_LOG = _struct(
    ("ts", T.TimestampType()), ("ip", S), ("status", I),
    ("headers", T.MapType(S, S)), ("body", S),
)
