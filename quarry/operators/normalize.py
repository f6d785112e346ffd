"""Flatten captured nested payloads into the seven typed detail tables.

Pipeline (all lazy; the plan layer persists ``chars`` and ``item_rows``):

    state --ok_records--> raw chars --latest_per_identity--> chars
    chars --parse_payloads--> parsed chars
    parsed --item_rows--> one row per item (gear ``#k`` and tree jewels ``#pk``)
    item_rows --> items, item_mods, skills;  parsed --> characters, passives,
    masteries, raw

Each payload is parsed exactly once with a declared schema whose leaves are
STRING (JSON text semantics), and every per-item lookup (first matching
property, link groups) is an expression evaluated inside the row: no
correlated subquery, no join, no shuffle. Shuffles happen only where the
semantics need them: the identity dedupe, the skill grouping and main-skill
pick, and the tree-dimension join (cluster passives resolve inside the row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas
from quarry.functions.scalars import (
    character_key,
    first_digits_int,
    first_value,
    flag,
    json_int,
    json_long,
    links,
)
from quarry.operators.common import latest_per_key

# Slots whose largest link group can be a character's main skill.
MAIN_SKILL_SLOTS = ["Weapon", "Weapon2", "BodyArmour"]


# ------------------------------------------------------------------ P1 / W1
def ok_records(state: DataFrame) -> DataFrame:
    """Keep ``ok`` lines, re-shaped to the transform input columns."""
    return (state.where(F.col("outcome") == "ok")
            .select("ordinal", "rank", "account", "character", "class", "level", "fetchedAt",
                    F.col("characterData").alias("items"),
                    F.col("passiveTree").alias("passives")))


def latest_per_identity(raw: DataFrame, keys: Sequence[str] = ("account", "character"),
                        order: Sequence[Column | str] = ("fetchedAt", "ordinal"),
                        row_id: str | None = "ordinal", in_place: bool = False) -> DataFrame:
    """One row per identity, the latest by ``order`` (fetchedAt, then the
    line ordinal as the tie-break); adds ``character_key``.

    Written as an aggregate (max of a struct) rather than ``row_number``:
    partial aggregation makes a hot identity cheap to dedupe. The line
    ordinal is unique, so only (identity, order, ordinal) go through the
    aggregate and the payload rows are kept by a semi join on the ordinal;
    with ``in_place`` the ordinals are written at once and the payloads are not
    shuffled.
    """
    latest = latest_per_key(raw, keys, order, row_id=row_id, in_place=in_place)
    return latest.select(character_key(keys[0], keys[1]).alias("character_key"), *latest.columns)


# Item fields that each detail table reads.
ITEMS_FIELDS = ["inventoryId", "name", "typeLine", "baseType", "rarity", "ilvl", "corrupted", "identified", "fractured",
                "synthesised", "mirrored", "split", "influences", "sockets", "properties", "requirements"]
MODS_FIELDS = [name for name, _ in schemas.MOD_FIELDS]
ATTRIBUTED_FIELDS = ["inventoryId", "name", "rarity", *MODS_FIELDS]
SKILLS_FIELDS = ["inventoryId", "sockets", "socketedItems"]


def _narrowed(schema: T.StructType, names: Sequence[str], item: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(item)) if f.name == "items" else f
                         for f in schema.fields if f.name in names])


def parse_payloads(chars: DataFrame, items: Sequence[str] | None = None, passives: Sequence[str] | None = None,
                   item_fields: Sequence[str] | None = None) -> DataFrame:
    """Parse both payloads once (declared schemas, STRING
    leaves). JSON paths become struct fields, JSON arrays typed arrays, and
    objects used as maps (jewel_data, mastery_effects) ``map<string,..>``,
    whose explode replaces the key listing. F3 is not needed: exploding a
    NULL or empty array yields no rows.

    A caller that reads some fields only names them (``items`` and
    ``passives`` of the documents, ``item_fields`` of their items): the parser
    still reads the whole text, and skips the others' values instead of
    building them."""
    item = schemas.ITEM if item_fields is None else T.StructType([f for f in schemas.ITEM.fields if f.name in item_fields])
    for name, schema, wanted in (("items", schemas.ITEMS_DOC, items), ("passives", schemas.PASSIVES_DOC, passives)):
        narrowed = _narrowed(schema, schema.names if wanted is None else wanted, item)
        if narrowed.fields:
            chars = chars.withColumn(f"{name}_doc", F.from_json(name, narrowed))
    return chars


# ---------------------------------------------------------------- P2 / O1
def characters(parsed: DataFrame, snapshot_id: str) -> DataFrame:
    """One row per character (12 columns), ordered by rank (NULLs last)."""
    ch = F.col("items_doc.character")
    return (parsed.select(
        "character_key",
        F.lit(snapshot_id).alias("snapshot_id"),
        F.col("rank").cast("int").alias("rank"),
        "account", "character", "class",
        ch["class"].alias("ascendancy"),
        json_int(ch["classId"]).alias("class_id"),
        json_int(ch["ascendancyClass"]).alias("ascendancy_class"),
        F.col("level").cast("int").alias("level"),
        json_long(ch["experience"]).alias("experience"),
        F.col("fetchedAt").alias("fetched_at"),
    ).orderBy(F.asc_nulls_last("rank")))


# ------------------------------------------------------------ U1 / W5
def item_rows(parsed: DataFrame) -> DataFrame:
    """U1 + W5: one row per item of both payloads with a stable ``item_id``:
    ``character_key#<k>`` for gear, ``character_key#p<k>`` for tree jewels
    (k = 0-based array position). One explode over the concatenated arrays,
    so the parsed rows are scanned once."""
    def tagged(arr: Column, prefix: str) -> Column:
        return F.transform(arr, lambda x, i: F.struct(
            F.concat(F.lit(prefix), i.cast("string")).alias("suffix"), x.alias("item")))
    item = parsed.schema["items_doc"].dataType["items"].dataType.elementType
    empty = F.array().cast(T.ArrayType(T.StructType([
        T.StructField("suffix", T.StringType()), T.StructField("item", item)])))
    both = F.concat(F.coalesce(tagged(F.col("items_doc.items"), "#"), empty),
                    F.coalesce(tagged(F.col("passives_doc.items"), "#p"), empty))
    return (parsed.select("character_key", F.explode(both).alias("r"))
            .select("character_key",
                    F.concat(F.col("character_key"), F.col("r.suffix")).alias("item_id"),
                    F.col("r.item").alias("item")))


# ---------------------------------------------------------------------- P3
def items(rows: DataFrame) -> DataFrame:
    """One row per item with an ``inventoryId`` (19 columns)."""
    it = F.col("item")
    return (rows.where(it["inventoryId"].isNotNull()).select(
        "character_key", "item_id",
        it["inventoryId"].alias("slot"),
        it["name"].alias("name"),
        F.coalesce(it["baseType"], it["typeLine"]).alias("base_type"),
        it["typeLine"].alias("type_line"),
        it["rarity"].alias("rarity"),
        json_int(it["ilvl"]).alias("ilvl"),
        flag(it["corrupted"]).alias("corrupted"),
        it["influences"].alias("influences"),
        links(it["sockets"]).alias("links"),
        first_digits_int(first_value(it["properties"], "Quality")).alias("quality"),
        it["sockets"].alias("sockets"),
        first_digits_int(first_value(it["requirements"], "Level")).alias("req_level"),
        flag(it["identified"]).alias("identified"),
        flag(it["fractured"]).alias("fractured"),
        flag(it["synthesised"]).alias("synthesised"),
        flag(it["mirrored"]).alias("mirrored"),
        flag(it["split"]).alias("split"),
    ))


# ---------------------------------------------------------------------- U2
def item_mods(rows: DataFrame) -> DataFrame:
    """One row per mod over the eight mod lists, in one scan of
    ``item_rows`` (items without an ``inventoryId`` contribute too)."""
    domains = F.array(*[
        F.struct(F.lit(label).alias("mod_domain"), F.col("item")[field].alias("mods"))
        for field, label in schemas.MOD_FIELDS
    ])
    return (rows.select("character_key", F.col("item_id").alias("item_key"),
                        F.inline(domains))
            .select("character_key", "item_key", "mod_domain",
                    F.explode("mods").alias("mod_text")))


# ----------------------------------------------------------- U6 / A10 / W2
def gems(rows: DataFrame) -> DataFrame:
    """One row per socketed gem with its link group (socket -> group);
    F7: ``get`` is NULL out of range instead of raising."""
    it = F.col("item")
    # The sockets are parsed below the explode: once per item, not once per gem.
    socketed = (rows.where(F.size(it["socketedItems"]) > 0)
                .select("character_key", it["inventoryId"].alias("slot"),
                        F.from_json(it["sockets"], schemas.SOCKETS)["group"].alias("groups"),
                        it["socketedItems"].alias("gems"))
                .select("character_key", "slot", "groups", F.explode("gems").alias("g")))
    g = F.col("g")
    return socketed.select(
        "character_key", "slot",
        F.get(F.col("groups"), g["socket"].cast("int")).cast("int").alias("link_group"),
        (g["support"] == F.lit("true")).alias("is_support"),
        g["typeLine"].alias("gem"),
        first_digits_int(first_value(g["properties"], "Level")).alias("level"),
        first_digits_int(first_value(g["properties"], "Quality")).alias("quality"),
    )


def skills_grouped(gem_rows: DataFrame) -> DataFrame:
    """A10: per (character, slot, link group): the active gem, level and
    quality each maxed independently, the support list, and the gem count
    (gems with a NULL support flag count but are neither active nor
    support). Groups without an active gem are dropped."""
    active = ~F.col("is_support")
    return (gem_rows.groupBy("character_key", "slot", "link_group").agg(
        F.max(F.when(active, F.col("gem"))).alias("gem"),
        F.max(F.when(active, F.col("level"))).alias("level"),
        F.max(F.when(active, F.col("quality"))).alias("quality"),
        F.array_sort(F.collect_list(F.when(F.col("is_support"), F.col("gem")))).alias("supports"),
        F.count(F.lit(1)).cast("int").alias("link_count"),
    ).where(F.col("gem").isNotNull()))


def _main_rank_key(slots: Sequence[str]) -> Column:
    """Ascending struct equivalent of ORDER BY (slot IN slots) DESC NULLS
    LAST, link_count DESC, gem, slot, link_group (NULLs last)."""
    in_set = F.col("slot").isin(*slots)
    return F.struct(
        F.when(in_set, 0).when(~in_set, 1).otherwise(2).alias("k0"),
        (-F.col("link_count")).alias("k1"),
        F.col("gem").isNull().alias("k2n"), F.col("gem").alias("k2"),
        F.col("slot").isNull().alias("k3n"), F.col("slot").alias("k3"),
        F.col("link_group").isNull().alias("k4n"), F.col("link_group").alias("k4"),
    )


def main_skill(grouped: DataFrame, slots: Sequence[str] = MAIN_SKILL_SLOTS) -> DataFrame:
    """Flag each character's main skill: the first group under the rank
    key, and only if its slot is a main-skill slot (a character may have
    none). A character's groups are a handful of rows; the window reuses the
    partitioning on ``character_key`` that ``skills`` gives its gems."""
    w = Window.partitionBy("character_key").orderBy(_main_rank_key(slots))
    ranked = grouped.withColumn("__k", F.row_number().over(w))
    is_first = F.col("__k") == 1
    return ranked.select(
        "character_key", "slot", "link_group", "gem", "level", "quality", "supports",
        "link_count", (is_first & F.col("slot").isin(*slots)).alias("is_main"))


def skills(rows: DataFrame, slots: Sequence[str] = MAIN_SKILL_SLOTS) -> DataFrame:
    """U6 + A10 + W2 from one scan and one exchange: gems are hashed by
    character, which serves the grouping and the ranking."""
    return main_skill(skills_grouped(gems(rows).repartition("character_key")), slots)


# ------------------------------------------------------- J1 / J2 / U3 / U7
def tree_allocations(parsed: DataFrame) -> DataFrame:
    """Allocated base-tree hashes, one row each (strict BIGINT cast)."""
    return (parsed.select("character_key", F.explode("passives_doc.hashes").alias("h"))
            .select("character_key", F.col("h").cast("bigint").alias("node_hash")))


def cluster_map(parsed: DataFrame) -> DataFrame:
    """One row per cluster-jewel sub-graph node: socket -> nodes."""
    sockets = parsed.select("character_key",
                            F.explode("passives_doc.jewel_data").alias("socket_key", "sock"))
    nodes = sockets.select("character_key",
                           F.explode("sock.subgraph.nodes").alias("node_key", "node"))
    return nodes.select("character_key", json_long("node_key").alias("node_hash"), "node")


def _tree_side(tree: DataFrame) -> DataFrame:
    return tree.select(F.col("hash"), F.col("name").alias("node_name"),
                       F.col("stats").alias("t_stats"), F.col("is_keystone").alias("t_key"))


def resolve_tree(alloc: DataFrame, tree: DataFrame) -> DataFrame:
    """Allocations LEFT JOIN the tree dimension on the node hash.
    Unresolved hashes stay with NULL name, [] stats, false keystone. Adaptive
    execution broadcasts a small dimension and splits popular nodes of a
    large one (the tree side has one row per hash)."""
    t = _tree_side(tree)
    j = alloc.join(t, alloc["node_hash"] == t["hash"], "left")
    return j.select(
        "character_key", "node_hash", "node_name",
        F.coalesce(F.col("t_stats"), F.array().cast("array<string>")).alias("node_stats"),
        F.coalesce(F.col("t_key"), F.lit(False)).alias("is_keystone"),
        F.lit("tree").alias("source"), F.lit(False).alias("is_notable"))


def _cluster_entries(parsed_doc: Column) -> Column:
    """U7 within one row: every sub-graph node of every jewel socket as
    (node_hash, node); nodes whose key is not a number never match."""
    sockets = F.map_values(parsed_doc["jewel_data"])
    per_socket = F.transform(sockets, lambda sock: F.transform(
        F.map_entries(sock["subgraph"]["nodes"]),
        lambda e: F.struct(json_long(e["key"]).alias("node_hash"), e["value"].alias("node"))))
    return F.filter(F.flatten(per_socket), lambda m: m["node"].isNotNull())


def _cluster_rows(doc: Column) -> Column:
    entries = _cluster_entries(doc)

    def resolve(h: Column) -> Column:
        hv = h.cast("bigint")
        hits = F.filter(entries, lambda m: m["node_hash"] == hv)
        none = F.array(F.struct(hv.alias("node_hash"),
                                F.lit(None).cast(schemas.CLUSTER_NODE).alias("node")))
        return F.when(F.size(hits) > 0, F.transform(hits, lambda m: F.struct(
            hv.alias("node_hash"), m["node"].alias("node")))).otherwise(none)
    return F.flatten(F.transform(F.coalesce(doc["hashes_ex"], F.array().cast("array<string>")), resolve))


def passives(parsed: DataFrame, tree: DataFrame) -> DataFrame:
    """Tree passives UNION ALL cluster passives, from one explode of
    each document and one join: tree allocations carry no node and are
    resolved by the tree join (J1), which cluster allocations, resolved inside
    the row (J2), pass through unmatched."""
    doc = F.col("passives_doc")
    tree_items = F.transform(F.coalesce(doc["hashes"], F.array().cast("array<string>")),
                             lambda h: F.struct(F.lit("tree").alias("source"),
                                                F.struct(h.cast("bigint").alias("node_hash"),
                                                         F.lit(None).cast(schemas.CLUSTER_NODE).alias("node"))
                                                .alias("a")))
    cluster_items = F.transform(_cluster_rows(doc), lambda a: F.struct(
        F.lit("cluster").alias("source"), a.alias("a")))
    rows = parsed.select("character_key", F.explode(F.concat(tree_items, cluster_items)).alias("r")) \
        .select("character_key", F.col("r.source").alias("source"), F.col("r.a").alias("a"))
    rows = rows.select("character_key", "source", F.col("a.node_hash").alias("node_hash"), F.col("a.node").alias("node"))
    t = _tree_side(tree)
    j = rows.join(t, (rows["node_hash"] == t["hash"]) & (rows["source"] == "tree"), "left")
    own = F.col("source") == "cluster"
    no_stats = F.array().cast("array<string>")
    return j.select(
        "character_key", "node_hash",
        F.when(own, F.col("node.name")).otherwise(F.col("node_name")).alias("node_name"),
        F.coalesce(F.when(own, F.col("node.stats")).otherwise(F.col("t_stats")), no_stats).alias("node_stats"),
        (~own & F.coalesce(F.col("t_key"), F.lit(False))).alias("is_keystone"), "source",
        (own & flag(F.col("node.isNotable"))).alias("is_notable"))


# ---------------------------------------------------------------------- U5
def masteries(parsed: DataFrame) -> DataFrame:
    """One row per chosen mastery (node -> effect); stats left empty
    (F9: a typed empty ``array<string>``)."""
    m = parsed.select("character_key",
                      F.explode("passives_doc.mastery_effects").alias("node_key", "effect"))
    return m.select("character_key", json_long("node_key").alias("node_hash"),
                    json_long("effect").alias("effect_hash"),
                    F.array().cast("array<string>").alias("effect_stats"))


# ---------------------------------------------------------------------- P4
def raw(chars: DataFrame) -> DataFrame:
    """The verbatim payload text per character."""
    return chars.select("character_key", "items", "passives")


# ---------------------------------------------------------------------- J7
def attributed_mods(rows: DataFrame) -> DataFrame:
    """J7 while flattening: the mods of items with an ``inventoryId``, with
    their item's slot, name and rarity carried through the same explode."""
    it = F.col("item")
    domains = F.array(*[F.struct(F.lit(label).alias("mod_domain"), it[field].alias("mods"))
                        for field, label in schemas.MOD_FIELDS])
    return (rows.where(it["inventoryId"].isNotNull())
            .select("character_key", F.col("item_id").alias("item_key"), it["inventoryId"].alias("slot"),
                    it["name"].alias("item_name"), it["rarity"].alias("rarity"), F.inline(domains))
            .withColumn("mod_text", F.explode("mods")).drop("mods"))


def attribute_mods(mods: DataFrame, item_table: DataFrame) -> DataFrame:
    """J7 over published tables: attach each mod to its exact item
    (item_key = item_id)."""
    it = item_table.select("item_id", "slot", F.col("name").alias("item_name"), "rarity")
    return mods.join(it, mods["item_key"] == it["item_id"], "inner").drop("item_id")
