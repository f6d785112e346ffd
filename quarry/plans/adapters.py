"""Adapters: build reference-shaped inputs from the driver's flat tables.

The engine's operators take nested JSON documents; the driver's tables are
flat. These adapters pack the flat rows into documents (a shuffle per
document key), the operators flatten them again, and the oracle SQL computes
the same answer straight from the flat tables. The mapping rules below are
mirrored one-to-one by the oracle SQL in ``quarry.plans.catalog``.

Snapshot documents (one state line per order):

* identity: account = ``c_name``, character = ``o_orderpriority`` (several
  orders share an identity, so the latest-per-identity dedupe has work);
  ordinal = ``o_orderkey``; outcome from ``o_orderstatus`` (F ok, O pending,
  P private); fetchedAt = ISO ``o_orderdate`` for ok lines.
* items[]: the order's lineitems sorted by (linenumber, partkey, suppkey),
  enriched with ``part``; sockets from the quantity, gems per socket.
* passives: tree hashes = partkeys (suppkey % 10 = 0 -> unresolved offset),
  jewels = lineitems of parts with p_size > 45, each with a cluster
  sub-graph; masteries from lineitems with linestatus F.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalars import epoch_ms_utc, iso_instant
from quarry.operators.common import keep_ids, with_global_ordinal

# Fixed values used by the mapping (mirrored by the oracle SQL).
UNRESOLVED_OFFSET = 1_000_000_000
CLUSTER_BASE = 2_000_000_000
JEWEL_MIN_SIZE = 45
KEYSTONE_MIN_SIZE = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _slot() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when((rf == "R") & (ls == "O"), F.lit(None).cast("string"))
            .when((rf == "A") & (ls == "F"), "Weapon")
            .when(rf == "A", "Weapon2")
            .when((rf == "N") & (ls == "F"), "BodyArmour")
            .when(rf == "N", "Flask")
            .otherwise("Ring"))


def _named(name: str, text: Column) -> Column:
    return F.struct(F.lit(name).alias("name"),
                    F.array(F.array(text, F.lit("0"))).alias("values"))


def _gear_item() -> Column:
    """The JSON item struct for one lineitem (NULL fields are omitted by
    ``to_json``, i.e. absent in the document)."""
    n = F.col("l_quantity").cast("int") % 7
    g = F.lit(1) + F.col("l_linenumber") % 3
    q = F.round(F.col("l_discount") * 100).cast("int")
    r = F.round(F.col("l_tax") * 1000).cast("int")
    size = F.col("p_size")

    # Sockets and gems are built per literal index 0..6 and sliced to n:
    # plain expressions compile to code, unlike per-element lambdas.
    def socket(i: int) -> Column:
        return F.struct(
            (F.lit(i) % g).alias("group"),
            F.lit("SDI"[i % 3]).alias("attr"),
            F.lit("RGB"[i % 3]).alias("sColour"))

    def gem(i: int) -> Column:
        lvl = F.lit(1) + (F.col("l_linenumber") + i) % 20
        suffix = ["Strike", "Slam"][i] if i < 2 else "Nova"
        active_name = F.when(size % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.col("p_type"), F.lit(" " + suffix)))
        support = (F.when(F.lit(i) < g, F.lit(False)).otherwise(F.lit(True)) if i != 5
                   else F.when(F.lit(i) < g, F.lit(False)).otherwise(F.lit(None).cast("boolean")))
        return F.struct(
            F.lit(i).alias("socket"),
            support.alias("support"),
            F.when(F.lit(i) < g, active_name)
             .otherwise(F.concat(F.col("p_brand"), F.lit(" Support"))).alias("typeLine"),
            F.array(
                _named("Level", F.when(lvl == 20, F.lit("20 (Max)")).otherwise(lvl.cast("string"))),
                _named("Quality", F.concat(F.lit("+"), ((F.col("l_partkey") + 3 * i) % 21).cast("string"),
                                           F.lit("%"))),
            ).alias("properties"))

    quality_prop = F.when(q > 0, F.array(_named("Quality", F.concat(F.lit("+"), q.cast("string"), F.lit("%")))))
    props = F.concat(F.array(_named("Armour", (size * 10).cast("string"))),
                     F.coalesce(quality_prop, F.array().cast("array<struct<name:string,values:array<array<string>>>>")))
    none_s = F.lit(None).cast("array<string>")
    return F.struct(
        _slot().alias("inventoryId"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("typeLine"),
        F.when(size % 2 == 0, F.col("p_brand")).alias("baseType"),
        F.when(size % 4 == 0, "Unique").when(size % 4 == 1, "Rare")
         .when(size % 4 == 2, "Magic").otherwise("Normal").alias("rarity"),
        F.col("l_quantity").alias("ilvl"),
        F.when(F.col("l_discount") >= 0.05, F.lit(True)).alias("corrupted"),
        (F.col("l_tax") > 0.02).alias("identified"),
        F.when(F.col("l_linenumber") == 1, F.lit(True)).alias("fractured"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit("true")).alias("synthesised"),
        F.when(size > 40, F.col("l_linenumber") % 2 == 0).alias("split"),
        F.when(size % 5 == 0, F.struct(F.lit(True).alias("shaper"))).alias("influences"),
        F.slice(F.array(*[socket(i) for i in range(7)]), 1, n).alias("sockets"),
        props.alias("properties"),
        F.array(_named("Str", F.lit("10")),
                _named("Level", F.concat(r.cast("string"), F.lit(" (gem)")))).alias("requirements"),
        F.when(F.col("l_linenumber") % 2 == 1,
               F.array(F.concat(F.lit("+"), F.col("l_quantity").cast("int").cast("string"),
                                F.lit(" to maximum Life")))).alias("implicitMods"),
        F.array(F.concat(F.col("p_brand"), F.lit(" affix")),
                F.concat(F.col("p_type"), F.lit(" suffix"))).alias("explicitMods"),
        F.when(F.col("l_returnflag") == "R",
               F.array(F.concat(F.lit("Crafted "), F.col("l_linestatus")))).alias("craftedMods"),
        F.when(size > JEWEL_MIN_SIZE, F.array(F.concat(F.lit("Enchant "), size.cast("string"))))
         .alias("enchantMods"),
        F.when(F.col("l_linenumber") == 1,
               F.array(F.concat(F.lit("Fractured "), F.col("p_name")))).alias("fracturedMods"),
        F.when(F.col("l_suppkey") % 10 == 3, F.array(F.lit("Veiled"))).alias("veiledMods"),
        F.array().cast("array<string>").alias("scourgeMods"),
        F.when(_slot() == "Flask", F.array(F.lit("Utility flask"))).otherwise(none_s).alias("utilityMods"),
        F.slice(F.array(*[gem(i) for i in range(7)]), 1, n).alias("socketedItems"),
    )


def _jewel_item() -> Column:
    return F.struct(
        F.lit("PassiveJewels").alias("inventoryId"),
        F.col("p_name").alias("name"),
        F.lit("Large Cluster Jewel").alias("typeLine"),
        F.lit("Magic").alias("rarity"),
        F.col("p_size").alias("ilvl"),
        F.array(F.concat(F.lit("Adds "), F.col("p_brand"))).alias("explicitMods"),
    )


def _cluster_nodes() -> Column:
    """Sub-graph node entries (key, node) of one jewel: m = 0, 1, 2 (m = 1
    missing when suppkey % 3 = 0, so that allocation stays unresolved)."""
    def node(m: int) -> Column:
        h = F.lit(CLUSTER_BASE) + F.col("l_partkey") * 10 + m
        return F.struct(h.cast("string").alias("key"), F.struct(
            h.alias("skill"),
            F.concat(F.col("p_name"), F.lit(f" node {m}")).alias("name"),
            F.lit(m == 0).alias("isNotable"),
            F.array(F.lit(f"Stat {m}"), F.col("p_type")).alias("stats")).alias("value"))
    return F.when(F.col("l_suppkey") % 3 != 0, F.array(node(0), node(1), node(2))) \
        .otherwise(F.array(node(0), node(2)))


def _joined(parts: Column) -> Column:
    return F.array_join(parts, ",")


def snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State lines (S1 columns) for every order, payloads on ok lines.

    Only narrow columns are shuffled and sorted; an element becomes JSON text
    where its line stands, behind the last exchange. Write it under
    ``wide_documents``: a task then holds one order at a time."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    outcome = (F.when(F.col("o_orderstatus") == "F", "ok")
               .when(F.col("o_orderstatus") == "O", "pending").otherwise("private"))
    is_ok = outcome == "ok"

    # Other lines carry no payload, so only the ok orders' lineitems are packed.
    ok_keys = orders.where(is_ok).select(F.col("o_orderkey").alias("l_orderkey"))
    li = keep_ids(lineitem, ok_keys, "l_orderkey")
    li = li.join(part, li["l_partkey"] == part["p_partkey"])
    # Position of each line in its order (k) and of each jewel among the
    # order's jewels (j). The window's partitioning on l_orderkey is reused
    # by the grouping below.
    is_jewel = F.col("p_size") > JEWEL_MIN_SIZE
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    li = (li.withColumn("k", F.row_number().over(w) - 1)
          .withColumn("j", F.when(is_jewel, F.sum(is_jewel.cast("int")).over(
              w.rowsBetween(Window.unboundedPreceding, 0)) - 1)))
    node_hash = F.when(F.col("l_suppkey") % 10 == 0, F.col("l_partkey") + UNRESOLVED_OFFSET) \
        .otherwise(F.col("l_partkey"))
    cluster_h = lambda m: F.lit(CLUSTER_BASE) + F.col("l_partkey") * 10 + m
    jewel_data = F.to_json(F.struct(
        F.lit("JewelPassiveTreeExpansionLarge").alias("type"),
        F.struct(F.map_from_entries(_cluster_nodes()).alias("nodes")).alias("subgraph")))
    packed = li.select(
        "l_orderkey", "k", F.to_json(_gear_item()).alias("item"), node_hash.cast("string").alias("node"),
        F.when(is_jewel, F.to_json(_jewel_item())).alias("jewel"),
        F.when(is_jewel, F.concat_ws(",", cluster_h(0).cast("string"), cluster_h(1).cast("string"))).alias("pair"),
        F.when(is_jewel, F.concat(F.lit('"'), F.col("j").cast("string"), F.lit('":'), jewel_data)).alias("jd"),
        F.when(F.col("l_linestatus") == "F", F.struct(
            (F.col("l_partkey") * 100 + F.col("k")).cast("string").alias("key"),
            F.col("l_suppkey").alias("value"))).alias("mastery"))
    # An order is one document: its lines, sorted by position.
    per_order = packed.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(*[c for c in packed.columns if c != "l_orderkey"]))).alias("lines"))

    character = F.struct(
        F.col("o_orderpriority").alias("name"),
        F.lit("Standard").alias("league"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("class"),
        F.col("c_nationkey").alias("classId"),
        (F.col("c_nationkey") % 3).cast("string").alias("ascendancyClass"),
        (F.col("c_nationkey") + 1).alias("level"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("experience"),
    )
    docs = (orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
            .join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left"))
    lines = F.coalesce(F.col("lines"), F.array().cast(per_order.schema["lines"].dataType))
    items = F.concat(F.lit('{"character":'), F.to_json(character), F.lit(',"items":['), _joined(lines["item"]), F.lit("]}"))
    passives = F.concat(
        F.lit('{"hashes":['), _joined(lines["node"]), F.lit('],"hashes_ex":['), _joined(lines["pair"]),
        F.lit('],"items":['), _joined(lines["jewel"]), F.lit('],"jewel_data":{'), _joined(lines["jd"]),
        F.lit('},"mastery_effects":'), F.to_json(F.map_from_entries(F.array_compact(lines["mastery"]))), F.lit("}"))
    return docs.select(
        F.col("o_orderkey").alias("ordinal"),
        F.col("o_custkey").cast("int").alias("rank"),
        F.col("c_name").alias("account"),
        F.col("o_orderpriority").alias("character"),
        F.col("c_mktsegment").alias("class"),
        (F.col("c_nationkey") + 1).cast("int").alias("level"),
        outcome.alias("outcome"),
        F.when(outcome == "pending", 0).otherwise(1).alias("attempts"),
        F.when(is_ok, iso_instant("o_orderdate")).alias("fetchedAt"),
        F.when(is_ok, items).alias("characterData"),
        F.when(is_ok, passives).alias("passiveTree"),
    )


def tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree dimension as NDJSON text lines (``value``), one node per part."""
    part = table(spark, sf_dir, "part")
    node = F.struct(F.col("p_partkey").alias("hash"), F.col("p_name").alias("name"),
                    F.array(F.col("p_type"), F.col("p_brand")).alias("stats"),
                    (F.col("p_size") >= KEYSTONE_MIN_SIZE).alias("is_keystone"))
    return part.select(F.to_json(node).alias("value"))


# ------------------------------------------------------------ state family
# Event type -> result outcome / items-call kind.
EVENT_OUTCOME = {"purchase": "ok", "view": "private", "signup": "dead",
                 "error": "retryable", "click": "retryable"}
EVENT_ITEMS_KIND = {"purchase": "ok", "view": "private", "signup": "dead",
                    "error": "retryable", "click": "rate_limited"}


def _case(col: str, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr


def customer_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster rows from ``customer``: identity (c_name, c_mktsegment)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("rank"),
                    F.col("c_name").alias("account"), F.col("c_mktsegment").alias("character"),
                    F.col("c_mktsegment").alias("class"), F.col("c_nationkey").alias("level"),
                    F.col("c_acctbal"), F.col("c_custkey"))


def event_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worker result lines from ``events``: user_id -> customer identity;
    two result files by event_id parity, line order = event_id."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = e.join(c, e["user_id"] == c["c_custkey"])
    outcome = _case("event_type", EVENT_OUTCOME)
    return j.select(
        F.col("c_name").alias("account"), F.col("c_mktsegment").alias("character"),
        outcome.alias("outcome"),
        (F.lit(1) + F.floor("value").cast("int") % 3).cast("int").alias("attempts"),
        F.when(outcome == "ok", iso_instant("ts")).alias("fetchedAt"),
        F.concat(F.lit("w0"), (F.col("event_id") % 2).cast("string")).alias("file"),
        F.col("event_id").alias("seq"))


def event_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resolution attempt per identity (its latest event): the items
    call kind from the event type, the passives call from the value."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = e.join(c, e["user_id"] == c["c_custkey"])
    return j.select(
        F.col("c_name").alias("account"), F.col("c_mktsegment").alias("character"),
        _case("event_type", EVENT_ITEMS_KIND).alias("items_kind"),
        F.when(F.col("value") >= 50, "retryable").otherwise("ok").alias("passives_kind"),
        "ts", "event_id")


def ladder_entries(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    """Ladder capture entries from ``orders``: capture 1 = orders before
    1998-01-01, capture 2 = the rest; entry order = o_orderkey."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    o = o.where(cut if first else ~cut)
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(F.col("o_orderkey").alias("offset"), F.lit(0).alias("pos"),
                    F.col("c_name").alias("account"), F.col("o_orderpriority").alias("character"),
                    F.col("c_mktsegment").alias("class"),
                    (F.col("o_orderkey") % 100).cast("int").alias("level"),
                    F.col("o_custkey").cast("int").alias("rank"))


# ---------------------------------------------------------- storage family
# League per document language; key kind per doc_id mod 16.
LEAGUE_BY_LANG = {"en": "Mirage", "fr": "Hardcore Mirage", "de": "Standard", "es": "Mirage (PL1)"}
LANG_POS = {"en": 0, "fr": 1, "de": 2, "es": 3}
PHASE_BY_MOD5 = ["collecting", "published", "transforming", "aborted", "ladder_capture"]


def _league_of(lang: str = "lang") -> Column:
    return _case(lang, LEAGUE_BY_LANG)


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object listing (doc_id, key, size) built from ``documents``:
    league from the language, snapshot id = source, key kind by doc_id."""
    from quarry.functions import keys as K
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lg, s, i = _league_of(), F.col("source"), F.col("doc_id")
    kind = i % 16
    key = (F.when(kind == 0, K.detail_key(lg, s, F.concat(F.lit("part-"), i.cast("string"))))
           .when(kind == 1, K.agg_key(lg, s, F.concat(F.lit("kind-"), i.cast("string"))))
           .when(kind == 2, K.meta_key(lg, s))
           .when(kind == 3, F.concat(K.raw_prefix(lg, s), i.cast("string"), F.lit(".json")))
           .when(kind == 4, K.chunk_key(lg, s, i % 100000))
           .when(kind == 5, K.snapshot_state_key(lg, s))
           .when(kind == 6, K.worker_result_key(lg, s, i % 15))
           .when(kind == 7, K.roster_key(lg))
           .when(kind == 8, K.checkpoint_key(lg))
           .when(kind == 9, K.worker_state_key(lg, F.concat(F.lit("w"), (i % 15).cast("string"))))
           .when(kind == 10, K.ip_pace_key(lg, F.concat(F.lit("10.0.0."), (i % 255).cast("string"))))
           .when(kind == 11, K.tree_cache_key(F.concat(F.lit("3."), (i % 5).cast("string"))))
           .when(kind == 12, K.economy_key(lg))
           .when(kind == 13, F.lit("index.json"))
           .when(kind == 14, F.concat(F.lit("misc/"), i.cast("string"), F.lit(".bin")))
           .otherwise(K.detail_key(lg, s, F.concat(F.lit("items-"), i.cast("string")))))
    return d.select("doc_id", key.alias("key"), F.col("n_chars").alias("size"))


def _snap_no() -> Column:
    return F.substring("source", 4, 10).cast("int")


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per (league, snapshot) seen in ``documents``."""
    d = table(spark, sf_dir, "documents").select("lang", "source").distinct()
    s = _snap_no()
    day = lambda off: F.lpad((s + off).cast("string"), 2, "0")
    phase = F.element_at(F.array(*[F.lit(p) for p in PHASE_BY_MOD5]), (s % 5 + 1).cast("int"))
    return d.select(
        _league_of().alias("league"), F.col("source").alias("snapshotId"),
        F.when(s % 6 == 5, 5).otherwise(6).alias("schemaVersion"),
        phase.alias("phase"),
        F.concat(F.lit("2024-01-"), day(1), F.lit("T12:00:00.000Z")).alias("ladderCapturedAt"),
        F.when(phase == "aborted", F.concat(F.lit("2024-01-"), day(2), F.lit("T00:00:00.000Z")))
        .alias("abortedAt"),
        (s * 10 + _case("lang", {k: str(v) for k, v in LANG_POS.items()}).cast("int")).alias("pos"))


def snapshot_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published meta per snapshot (missing for s mod 7 = 6; an unparsable
    updatedAt for s mod 7 = 5)."""
    d = table(spark, sf_dir, "documents").select("lang", "source").distinct()
    s = _snap_no()
    day = F.lpad((s + 2).cast("string"), 2, "0")
    return d.where(s % 7 != 6).select(
        _league_of().alias("league"), F.col("source").alias("snapshot_id"),
        F.when(s % 5 == 1, F.concat(F.lit("2024-01-"), day, F.lit("T00:00:00.000Z"))).alias("completedAt"),
        F.when(s % 7 == 5, F.lit("not-a-date"))
        .otherwise(F.concat(F.lit("2024-01-"), day, F.lit("T06:00:00.000Z"))).alias("updatedAt"))


# ---------------------------------------------------------- request family
# Status per event type; the advertised limit header.
EVENT_STATUS = {"purchase": "200", "view": "403", "signup": "404", "error": "500", "click": "429"}
LIMIT_HEADER = "2:3600:60,5:86400:600"


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP responses from ``events``: ip = user, JSON body = props, rate
    headers on every response, Retry-After (seconds) on 429s."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    state = F.concat((k % 5).cast("string"), F.lit(":3600:"),
                     F.when(k % 3 == 0, F.lit("60")).otherwise(F.lit("0")), F.lit(","),
                     (k % 7).cast("string"), F.lit(":86400:0"))
    status = _case("event_type", EVENT_STATUS).cast("int")
    base = F.create_map(F.lit("x-rate-limit-rules"), F.lit("Ip"),
                        F.lit("x-rate-limit-ip"), F.lit(LIMIT_HEADER),
                        F.lit("x-rate-limit-ip-state"), state)
    retry = F.create_map(F.lit("retry-after"), F.floor("value").cast("string"))
    headers = F.when(status == 429, F.map_concat(base, retry)).otherwise(base)
    body = F.when(status == 500, F.lit("upstream failure")).otherwise(F.col("props"))
    ts_ms = epoch_ms_utc("ts")  # zone-less event time read as UTC
    return e.select(F.col("user_id").cast("string").alias("ip"), F.col("event_id").alias("seq"),
                    F.timestamp_millis(ts_ms).alias("ts"), ts_ms.alias("ts_ms"),
                    status.alias("status"), headers.alias("headers"), body.alias("body"))


def response_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with HTML (pages), prose (documents) and JSON (events)
    bodies for the classifier."""
    p = table(spark, sf_dir, "pages")
    d = table(spark, sf_dir, "documents")
    empty = F.create_map().cast("map<string,string>")
    pages = p.select(F.lit("pages").alias("source"), F.col("page_id").alias("id"),
                     F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 503, 400)]),
                                  (F.col("page_id") % 5 + 1).cast("int")).alias("status"),
                     F.when(F.col("page_id") % 7 == 0,
                            F.create_map(F.lit("cf-mitigated"), F.lit("challenge")))
                     .otherwise(empty).alias("headers"),
                     F.col("html").alias("body"))
    docs = d.select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"),
                    F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 418)]),
                                 (F.col("doc_id") % 4 + 1).cast("int")).alias("status"),
                    empty.alias("headers"), F.col("text").alias("body"))
    ev = request_log(spark, sf_dir).select(F.lit("events").alias("source"), F.col("seq").alias("id"),
                                           "status", "headers", "body")
    return pages.unionByName(docs).unionByName(ev)


# ---------------------------------------------------------- economy family
def league_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League rows from ``nation``: region 0 nations are permanent; start
    and end dates from the nation key, some missing or unparsable."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    day = lambda off: F.lpad(((k + off) % 28 + 1).cast("string"), 2, "0")
    return n.select(
        F.col("n_name").alias("id"),
        F.when(F.col("n_regionkey") == 0, F.lit("Standard"))
        .otherwise(F.concat(F.lit("cat"), F.col("n_regionkey").cast("string"))).alias("category_id"),
        F.when(k % 6 == 5, F.lit(None).cast("string"))
        .when(k % 6 == 4, F.lit("soon"))
        .otherwise(F.concat(F.lit("2024-01-"), day(0), F.lit("T00:00:00Z"))).alias("start_at"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 3, F.lit("garbage"))
        .otherwise(F.concat(F.lit("2024-02-"), day(3), F.lit("T00:00:00Z"))).alias("end_at"),
        k.alias("pos"))


def economy_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category fetches from ``events``: league = the user's nation, pair =
    event_id mod 43 in catalogue order, status by event type."""
    from quarry.operators.economy import CATALOGUE_PAIRS
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cat = spark.createDataFrame([(i, ep, t) for i, (ep, t) in enumerate(CATALOGUE_PAIRS)],
                                "pair_pos int, endpoint string, type string")
    j = (e.join(c, e["user_id"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
         .withColumn("pair_pos", (F.col("event_id") % len(CATALOGUE_PAIRS)).cast("int"))
         .join(F.broadcast(cat), "pair_pos"))
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "click", 429) \
        .otherwise(200)
    return j.select(F.col("n_name").alias("league"), "endpoint", "type", status.alias("status"),
                    "ts", F.col("event_id").alias("seq"))


# ----------------------------------------------------------- ladder pages
# Ladder depth and page size of the capture configuration.
LADDER_DEPTH = 500
LADDER_PAGE = 200


def ladder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured ladder pages, one capture per region: all orders ranked by
    total price, ``LADDER_PAGE`` entries per page (the operator applies the
    depth). Region 3 lost its page at offset 200; region 4's page at offset
    400 is malformed (no ``entries``). Some entries lack an account name or
    have a number for it (dropped on scan)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
         .join(r, n["n_regionkey"] == r["r_regionkey"]))
    totals = j.groupBy("r_regionkey").agg(F.count(F.lit(1)).alias("total"))
    # Rank within the region: a global ordinal by (region, price) less the
    # orders of the regions before it, so a large region is not one task.
    first = totals.withColumn("first", F.sum("total").over(Window.orderBy("r_regionkey")) - F.col("total")) \
        .select("r_regionkey", "first")
    top = (with_global_ordinal(j, ["r_regionkey", F.desc("o_totalprice"), F.asc("o_orderkey")])
           .join(F.broadcast(first), "r_regionkey")  # a row per region, and regions are five
           .withColumn("rk", (F.col("ordinal") - F.col("first") + 1).cast("int")))
    entry = F.struct(
        F.col("rk").alias("rank"),
        F.struct(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("name"),
                 F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 100).cast("int")).alias("level"),
                 F.when(F.col("o_orderpriority") != "5-LOW", F.col("c_mktsegment")).alias("class"))
        .alias("character"),
        F.when(F.col("o_orderkey") % 59 == 0, F.parse_json(F.concat(F.lit('{"name":'), F.col("o_orderkey").cast("string"), F.lit("}"))))
        .otherwise(F.parse_json(F.to_json(F.struct(F.when(F.col("o_orderkey") % 53 != 0, F.col("c_name")).alias("name")))))
        .alias("account"))
    top = top.select("r_regionkey",
                     (F.floor((F.col("rk") - 1) / LADDER_PAGE) * LADDER_PAGE).cast("long").alias("offset"),
                     F.struct(((F.col("rk") - 1) % LADDER_PAGE).alias("pos"), entry.alias("e")).alias("pe"))
    grouped = top.groupBy("r_regionkey", "offset").agg(F.array_sort(F.collect_list("pe"), lambda a, b: a["pos"] - b["pos"])
                                                        .alias("pes"))
    expected = (r.join(totals, "r_regionkey", "left").withColumn("offset", F.explode(F.expr(
        f"sequence(0L, greatest({LADDER_DEPTH} - 1, coalesce(total, 0) - 1), {LADDER_PAGE}L)"))))
    pages = (expected.join(grouped, ["r_regionkey", "offset"], "left")
             .withColumn("total", F.coalesce("total", F.lit(0)).cast("int")))
    entries = F.coalesce(F.col("pes")["e"], F.from_json(F.lit("[]"), T.ArrayType(
        grouped.schema["pes"].dataType.elementType["e"].dataType)))
    lost = (F.col("r_regionkey") == 3) & (F.col("offset") == 200)
    malformed = (F.col("r_regionkey") == 4) & (F.col("offset") == 400)
    doc = F.when(malformed, F.to_json(F.struct("total"))) \
        .otherwise(F.to_json(F.struct(F.col("total"), entries.alias("entries"))))
    return pages.where(~lost).select(F.col("r_name").alias("capture"), "offset", doc.alias("doc"))
