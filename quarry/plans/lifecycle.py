"""Lifecycle queries: files are staged from the driver's tables under the
shared checkpoint folder, read or written by the operators under test, and
compared with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import keys as K
from quarry.operators import aggregates as AG
from quarry.operators import roster as RO
from quarry.operators import state as ST
from quarry.operators import storage as SO
from quarry.operators.common import with_global_ordinal
from quarry.plans import adapters as AD
from quarry.plans import catalog as C
from quarry.plans import snapshot
from quarry.session import checkpoint_root
from quarry.sources import buckets as BK
from quarry.sources import documents as D
from quarry.sources import sinks
from quarry.sources import state as SS
from quarry.sources import tree as TR
from quarry.streaming import keyed, pacing

_COUNTS = {
    "characters": "SELECT count(*) FROM ch", "raw": "SELECT count(*) FROM ch",
    "items": "SELECT (SELECT count(*) FROM li WHERE slot IS NOT NULL) + (SELECT count(*) FROM jw)",
    "item_mods": """SELECT (SELECT sum(2 + (l_linenumber % 2 = 1)::INT + (l_returnflag = 'R')::INT + (p_size > 45)::INT
      + (l_linenumber = 1)::INT + (l_suppkey % 10 = 3)::INT + coalesce(slot = 'Flask', false)::INT) FROM li) + (SELECT count(*) FROM jw)""",
    "skills": "SELECT count(*) FROM sk", "passives": "SELECT (SELECT count(*) FROM li) + (SELECT 2 * count(*) FROM jw)",
    "masteries": "SELECT count(*) FROM li WHERE l_linestatus = 'F'",
    "class_distribution": "SELECT count(DISTINCT c_mktsegment) FROM ch",
    "skill_popularity": "SELECT count(DISTINCT gem) FROM sk WHERE is_main",
    "unique_usage": "SELECT count(DISTINCT p_name) FROM li WHERE slot IS NOT NULL AND p_size % 4 = 0 AND p_name <> ''",
    "keystone_usage": "SELECT count(DISTINCT p_name) FROM li WHERE l_suppkey % 10 <> 0 AND p_size >= 48",
    "catalogue": "SELECT 1", "meta characters": "SELECT count(*) FROM ch", "meta total": "SELECT total FROM t",
}


@C.register("published_tables", C._SKILLS_CTE + C._IDENTITY_CTE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(({sql}) AS BIGINT) AS rows" for name, sql in _COUNTS.items()))
def q_published_tables(spark, sf_dir):
    """A snapshot published under the manifest's
    total, read back through its pointer and its contract."""
    root = checkpoint_root(spark, "published", unique=True)
    tally = AG.tally_outcomes(snapshot.identity_state(spark, sf_dir))
    claimed = snapshot.claimed_total(spark, sf_dir).first()["total_characters"]
    gate = sinks.publish_snapshot(snapshot.from_tables(spark, sf_dir), tally, f"{root}/snapshot", "Standard", C.NOW_1, now=C.NOW_2,
                                  total_characters=claimed, depth=500, tree_version="3.0", catalogue_path=f"{root}/catalogue")
    if not gate["ok_to_publish"]:
        raise RuntimeError(f"refused: {gate['errors']}")
    at = sinks.current(spark, f"{root}/snapshot")
    named = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
    out = named(sinks.read_catalogue(spark, f"{root}/catalogue"), "catalogue")
    for name in schemas.DETAIL_TABLES:
        out = out.unionByName(named(sinks.read_detail(spark, f"{at}/detail/{name}", name), name))
    docs = spark.read.json(f"{at}/agg/json")  # S15: a document per kind
    out = out.unionByName(docs.select(F.col("kind").alias("name"), F.size("rows").cast("long").alias("rows")))
    meta = spark.read.json(f"{at}/meta")
    return out.unionByName(meta.select(F.lit("meta characters").alias("name"), F.col("characterCount").alias("rows"))) \
        .unionByName(meta.select(F.lit("meta total").alias("name"), F.col("totalCharacters").alias("rows")))


@C.register("popularity_order", C._SNAP_CTE + """,
k AS (
  SELECT 'class_distribution' AS kind, c_mktsegment AS name, count(*) AS count FROM ch GROUP BY ALL
  UNION ALL
  SELECT 'unique_usage', p_name, count(DISTINCT character_key) FROM li
  WHERE slot IS NOT NULL AND p_size % 4 = 0 AND p_name <> '' GROUP BY ALL
)
SELECT kind, name, count, row_number() OVER (PARTITION BY kind ORDER BY count DESC, name) - 1 AS position FROM k""")
def q_popularity_order(spark, sf_dir):
    """O2: count descending, name ascending, as a position per kind."""
    s = snapshot.from_tables(spark, sf_dir)
    both = s.aggregate("class_distribution").unionByName(s.aggregate("unique_usage"))
    return AG.count_positions(both).select("kind", "name", "count", "position")


@C.register("character_order", C._SNAP_CTE + """
SELECT CAST(o_custkey AS INTEGER) AS rank, row_number() OVER (ORDER BY o_custkey) - 1 AS position FROM ch""")
def q_character_order(spark, sf_dir):
    """O1: characters by rank, as a dense position."""
    characters = snapshot.from_tables(spark, sf_dir).table("characters").select("rank", "character_key")
    placed = with_global_ordinal(characters, [F.asc_nulls_last("rank"), F.col("character_key")], "position")
    return placed.select("rank", "position")


@C.register("roster_order", C._ROSTER_CTE + """
SELECT account, "character", rank, row_number() OVER (ORDER BY rank, firstSeenAt, account || chr(0) || "character") - 1 AS position
FROM r2""")
def q_roster_order(spark, sf_dir):
    """Rank, first seen, identity, under locale-aware comparison."""
    roster = C._rosters(spark, sf_dir)[0]
    placed = with_global_ordinal(roster, RO.roster_keys(), "position")
    return placed.select("account", "character", "rank", "position")


def _one_per_file(df, path):
    """Stage JSON documents, one file each."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return f"{path}/part-*"


def _one_document(df, path, head, tail):
    """Stage rows with a dense ``pos`` as one JSON document: lines in order
    through the task that writes the file, one at a time."""
    entry = F.to_json(F.struct(*[c for c in df.columns if c != "pos"]))
    lines = df.select(F.col("pos").cast("long").alias("pos"), F.concat(F.when(F.col("pos") > 0, F.lit(",")).otherwise(F.lit("")), entry).alias("value"))
    ends = df.sparkSession.createDataFrame([(-1, head), ((1 << 63) - 1, tail)], "pos long, value string")
    lines.unionByName(ends).repartitionByRange(1, "pos").sortWithinPartitions("pos").select("value").write.text(path)


@C.register("catalogue_document", C._INV_CTE + """
SELECT league, snapshot_id, ladderCapturedAt, schemaVersion, CAST(s AS VARCHAR) AS kept FROM man""")
def q_catalogue_document(spark, sf_dir):
    """The index as one document, read by byte ranges; a field that the
    scan doesn't know stays in its entry."""
    m = AD.manifests(spark, sf_dir)
    rows = m.select("league", F.col("snapshotId").alias("snapshotId"), "ladderCapturedAt", "schemaVersion",
                    F.substring("snapshotId", 4, 10).alias("own"))
    placed = with_global_ordinal(rows, ["league", "snapshotId"], "pos")
    first = placed.groupBy("league").agg(F.min("pos").alias("pos")).withColumn("opens", F.lit(True))
    entry = F.to_json(F.struct("snapshotId", "ladderCapturedAt", "schemaVersion", "own"))
    opening = F.concat(F.when(F.col("pos") > 0, F.lit("]},")).otherwise(F.lit("")), F.lit('{"league":'),
                       F.to_json(F.array("league")).substr(F.lit(2), F.length(F.to_json(F.array("league"))) - 2), F.lit(',"snapshots":['))
    lines = placed.join(first, ["league", "pos"], "left").select("pos", F.concat(F.when(F.col("opens"), opening).otherwise(F.lit(",")), entry).alias("value"))
    ends = spark.createDataFrame([(-1, '{"schemaVersion":6,"leagues":['), ((1 << 63) - 1, "]}]}")], "pos long, value string")
    path = checkpoint_root(spark, "index-document", unique=True)
    lines.unionByName(ends).repartitionByRange(1, "pos").sortWithinPartitions("pos").select("value").write.text(path)
    found = D.scan_catalogue(spark, f"{path}/part-*")
    return found.select("league", "snapshot_id", "ladderCapturedAt", "schemaVersion", F.get_json_object("entry", "$.own").alias("kept"))


@C.register("manifest_documents", C._INV_CTE + """
SELECT league, snapshot_id AS "snapshotId", phase, schemaVersion <> 6 AS hidden,
  phase IN ('ladder_capture', 'collecting', 'transforming') AND schemaVersion <> 6 AS "foreign"
FROM man""")
def q_manifest_documents(spark, sf_dir):
    """S9 -> P11, P16: manifests read from documents; the full read hides
    foreign versions, the light one shows them, and P16 finds them."""
    m = AD.manifests(spark, sf_dir).drop("pos")
    docs = m.withColumn("totalCharacters", F.lit(1)).withColumn("outcomes", F.struct(F.lit(0).alias("ok")))
    path = _one_per_file(docs, checkpoint_root(spark, "manifests", unique=True))
    keys = ["league", "snapshotId"]
    full = D.scan_manifests(spark, path).select(*keys, F.lit(False).alias("hidden"))
    seen = D.peek_manifests(spark, path)
    foreign = SO.foreign_schema(seen).select(*keys, F.lit(True).alias("foreign"))
    return (seen.select(*keys, "phase").join(full, keys, "left").join(foreign, keys, "left")
            .select(*keys, "phase", F.coalesce("hidden", F.lit(True)).alias("hidden"),
                    F.coalesce("foreign", F.lit(False)).alias("foreign")))


@C.register("foreign_discard", C._INV_CTE + """,
gone AS (SELECT league, snapshot_id FROM man WHERE phase IN ('ladder_capture', 'collecting', 'transforming') AND schemaVersion <> 6)
SELECT 'key' AS what, cls.league_name AS league, cls.snap AS snapshot_id, CAST(doc_id AS VARCHAR) AS item FROM cls
JOIN gone g ON g.league = cls.league_name AND g.snapshot_id = cls.snap
WHERE cls.category IN ('detail', 'agg', 'meta', 'raw', 'chunk', 'snapshot-state', 'worker-result')
UNION ALL
SELECT 'catalogue', league, snapshot_id, phase FROM man WHERE NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.league = man.league AND gone.snapshot_id = man.snapshot_id)""")
def q_foreign_discard(spark, sf_dir):
    """P16 -> J11: foreign in-flight snapshots lose their keys and their catalogue rows."""
    m = AD.manifests(spark, sf_dir).withColumnRenamed("snapshotId", "snapshot_id")
    gone = SO.foreign_schema(m).select("league", "snapshot_id")
    keys, left = SO.discard(C._classified(spark, sf_dir), gone, m.select("league", "snapshot_id", "phase"))
    return keys.select(F.lit("key").alias("what"), "league", "snapshot_id", F.col("doc_id").cast("string").alias("item")) \
        .unionByName(left.select(F.lit("catalogue").alias("what"), "league", "snapshot_id", F.col("phase").alias("item")))


@C.register("catalogue_roundtrip", C._INV_CTE + f"""
SELECT league, snapshot_id, ladderCapturedAt, phase <> 'published' AS upserted, s % 3 <> 0 AS "hasDetail", '{C.NOW_2}' AS "updatedAt"
FROM man WHERE phase IN ('published', 'transforming') AND s % 4 <> 3""")
def q_catalogue_roundtrip(spark, sf_dir):
    """S22 -> S20 -> J10 -> S22: the catalogue table rewritten from itself
    three times (upsert, trim mark, removal)."""
    path = checkpoint_root(spark, "catalogue", unique=True)
    m = AD.manifests(spark, sf_dir).withColumnRenamed("snapshotId", "snapshot_id").withColumn(
        "s", F.substring("snapshot_id", 4, 10).cast("int"))
    rows = m.select("league", "snapshot_id", "ladderCapturedAt", (F.col("phase") != "published").alias("upserted"),
                    F.lit(True).alias("hasDetail"), "phase", "s")
    steps = [lambda c: rows.where(F.col("phase") == "published").drop("phase", "s"),
             lambda c: SO.catalogue_upsert(c, rows.where(F.col("phase") == "transforming").drop("phase", "s")),
             lambda c: SO.mark_trimmed(c, rows.where(F.col("s") % 3 == 0)),
             lambda c: SO.catalogue_remove(c, rows.where(F.col("s") % 4 == 3))]
    for step in steps:
        known = sinks.read_catalogue(spark, path)
        sinks.write_catalogue(step(known if known is None else known.drop("updatedAt")), path, C.NOW_2)
    return sinks.read_catalogue(spark, path).select("league", "snapshot_id", "ladderCapturedAt", "upserted", "hasDetail", "updatedAt")


@C.register("state_files", C._STATE_CTE + """
SELECT account, "character", outcome, attempts, fetchedAt, row_number() OVER (ORDER BY ordinal) - 1 AS ordinal FROM merged""")
def q_state_files(spark, sf_dir):
    """S17 -> S1 and S2 -> J3: the seeded state written and scanned back,
    worker result files scanned leniently and merged into it."""
    root = checkpoint_root(spark, "state-files", unique=True)
    state = SS.scan_state(spark, SS.write_state(C._seeded(spark, sf_dir), f"{root}/state", 4))
    # A worker writes a file per range of its lines, named in their order.
    lines = AD.event_results(spark, sf_dir).withColumns({"worker": F.col("file"), "range": F.lpad(F.floor(F.col("seq") / 5_000).cast("string"), 12, "0")})
    (lines.repartition("worker", "range").sortWithinPartitions("worker", "range", "seq").drop("file", "seq")
     .write.partitionBy("worker", "range").option("compression", "gzip").json(f"{root}/results"))
    results = SS.scan_results(spark, f"{root}/results/*/*/*.json.gz")
    merged = ST.merge_results(state, results.select("account", "character", "outcome", "attempts", "fetchedAt", "file", "seq"))
    return merged.select("account", "character", "outcome", "attempts", "fetchedAt", "ordinal")


@C.register("tree_documents", """
SELECT '3.' || r_regionkey AS version, p_partkey AS hash, CASE WHEN p_size % 6 = 0 THEN '' ELSE p_name END AS name,
  p_type AS stats, p_size >= 48 AS is_keystone
FROM part, region WHERE p_partkey % 5 = r_regionkey""")
def q_tree_documents(spark, sf_dir):
    """S6 -> S5 -> S7: tree documents (arrays and objects, a name that is a
    number, stats that are not strings, a key that is no number) normalised,
    written and pinned by version."""
    part = AD.table(spark, sf_dir, "part")
    version = (F.col("p_partkey") % 5).cast("string")
    name = F.when(F.col("p_size") % 6 == 0, F.lit("7")).otherwise(F.to_json(F.array("p_name")).substr(F.lit(2), F.length(F.to_json(F.array("p_name"))) - 2))
    stats = F.concat(F.lit("["), F.to_json(F.array("p_type")).substr(F.lit(2), F.length(F.to_json(F.array("p_type"))) - 2), F.lit(',5,null,{"q":1}]'))
    flag = F.when(F.col("p_size") % 2 == 0, "isKeystone").otherwise("is_keystone")
    body = F.concat(F.lit('"name":'), name, F.lit(',"stats":'), stats, F.lit(',"'), flag, F.lit('":'), (F.col("p_size") >= 48).cast("string"), F.lit("}"))
    rows = part.select(version.alias("v"), "p_partkey", body.alias("body"))
    # Documents of a thousand hashes: a version has many.
    docs = rows.groupBy("v", F.floor(F.col("p_partkey") / 1_000).alias("range")).agg(
        F.array_join(F.collect_list(F.concat(F.lit('{"hash":'), F.col("p_partkey").cast("string"), F.lit(","), F.col("body"))), ",").alias("arr"),
        F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("p_partkey").cast("string"), F.lit('":{'), F.col("body"))), ",").alias("obj"))
    doc = F.when(F.col("v").cast("int") % 2 == 0, F.concat(F.lit('{"nodes":['), "arr", F.lit("]}"))) \
        .otherwise(F.concat(F.lit('{"nodes":{"root":{"name":"r"},'), "obj", F.lit("}}")))
    tree = TR.normalize_tree(docs.select(doc.alias("doc"), F.concat(F.lit("3."), "v").alias("version")))
    path = checkpoint_root(spark, "trees", unique=True)
    tree.write.partitionBy("version").json(path)
    out = None
    for v in range(5):
        scanned = TR.scan_tree(spark, f"{path}/version=3.{v}").withColumn("version", F.lit(f"3.{v}"))
        one = TR.pin_tree(scanned, f"3.{v}").withColumn("version", F.lit(f"3.{v}"))
        out = one if out is None else out.unionByName(one)
    return out.select("version", "hash", "name", F.array_join("stats", "|").alias("stats"), "is_keystone")


@C.register("incremental_publish", C._STATE_CTE + """,
t AS (SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'ok') AS ok,
  count(*) FILTER (WHERE outcome IN ('pending', 'retryable')) AS pending FROM merged)
SELECT total, ok, pending, ok AS characters, pending = 0 AS complete, true AS "replayed_same" FROM t""")
def q_incremental_publish(spark, sf_dir):
    """R1 as a flow: per batch of result files merge, tally and publish what
    there is; the last publication holds every ok character. The stream is
    then replayed from the start into the same publication."""
    root = checkpoint_root(spark, "incremental-publish", unique=True)
    doc = F.to_json(F.struct(F.struct(F.col("account").alias("class")).alias("character"), F.array().cast("array<string>").alias("items")))
    is_ok = F.col("outcome") == "ok"
    results = AD.event_results(spark, sf_dir).withColumn("characterData", F.when(is_ok, doc)) \
        .withColumn("passiveTree", F.when(is_ok, F.lit('{"hashes":[]}')))
    src = C.SM.stage_files(results, f"{root}/results", 2, ["seq"])
    schema = spark.read.parquet(src).schema
    seed = C._seeded(spark, sf_dir)
    claimed = AD.table(spark, sf_dir, "customer").count()
    tree = TR.parse_tree_lines(AD.tree_lines(spark, sf_dir))

    def publish(merged, batch):
        gate = sinks.publish_snapshot(snapshot.normalise(merged, tree), AG.tally_outcomes(merged), f"{root}/published", "Standard",
                                      C.NOW_1, now=C.NOW_2, total_characters=claimed)
        if not gate["ok_to_publish"]:
            raise RuntimeError(f"refused: {gate['errors']}")

    def published():
        at = sinks.current(spark, f"{root}/published")
        meta = spark.read.json(f"{at}/meta").select(F.col("totalCharacters").alias("total"), F.col("coverage.ok").alias("ok"),
                                                    F.col("pendingCount").alias("pending"), "complete")
        return meta.crossJoin(sinks.read_detail(spark, f"{at}/detail/characters", "characters")
                              .agg(F.count(F.lit(1)).alias("characters")))  # one row each

    each = C.SM.files_a_batch(spark, src, 2)
    C.SM.incremental_merge(spark, seed, src, schema, f"{root}/first", files_per_trigger=each, on_batch=publish)
    once = published().first()
    C.SM.incremental_merge(spark, seed, src, schema, f"{root}/again", files_per_trigger=2 * each, on_batch=publish)
    return published().withColumn("replayed_same", F.struct("total", "ok", "pending", "complete", "characters") == F.struct(
        *[F.lit(once[c]).alias(c) for c in ("total", "ok", "pending", "complete", "characters")]))


@C.register("source_documents", C._ROSTER_CTE + """,
ev AS (SELECT count(*) AS n FROM events)
SELECT 'roster' AS source, count(*) AS rows, CAST(sum(rank) AS BIGINT) AS check_sum FROM r2
UNION ALL SELECT 'leagues', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation
UNION ALL SELECT 'meta', count(*), CAST(sum(s) AS BIGINT) FROM (
  SELECT DISTINCT lang, source, CAST(substr(source, 4) AS INTEGER) AS s FROM documents) WHERE s % 7 <> 6
UNION ALL SELECT 'inventory', count(*), CAST(sum(s) AS BIGINT) FROM (
  SELECT DISTINCT lang, source, CAST(substr(source, 4) AS INTEGER) AS s FROM documents) WHERE s % 7 <> 6
UNION ALL SELECT 'raw', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
UNION ALL SELECT 'empty', 0, NULL""")
def q_source_documents(spark, sf_dir):
    """Documents staged from the tables and read
    back by their scans."""
    root = checkpoint_root(spark, "documents", unique=True)
    # One document each, a line per entry; read back by byte ranges.
    roster = with_global_ordinal(C._rosters(spark, sf_dir)[0], RO.roster_keys(), "pos")
    _one_document(roster, f"{root}/roster", f'{{"schemaVersion":{schemas.SCHEMA_VERSION},"characters":[', "]}")
    _one_document(AD.league_rows(spark, sf_dir), f"{root}/leagues", "[", "]")
    meta = AD.snapshot_meta(spark, sf_dir)
    meta.select(F.to_json(F.struct("completedAt", "updatedAt")).alias("value"), F.col("league").alias("l"), F.col("snapshot_id").alias("s")) \
        .write.partitionBy("l", "s").text(f"{root}/meta")
    raw = snapshot.staged_state(spark, sf_dir).where(F.col("outcome") == "ok").select(
        "ordinal", "rank", "account", "character", "class", "level", "fetchedAt", F.col("characterData").alias("items"), F.col("passiveTree").alias("passives"))
    raw.write.option("compression", "gzip").json(f"{root}/raw")
    got = [("roster", D.scan_roster(spark, f"{root}/roster/part-*"), F.col("rank")),
           ("leagues", D.scan_leagues(spark, f"{root}/leagues/part-*"), F.col("pos")),
           ("meta", D.scan_meta(spark, f"{root}/meta/*/*/part-*"), F.regexp_extract("file", r"/s=src(\d+)/", 1).cast("long")),
           ("inventory", D.scan_inventory(spark, f"{root}/meta").where(F.col("key").endswith(".txt")),
            F.regexp_extract("key", r"^l=[^/]+/s=src(\d+)/", 1).cast("long")),
           ("raw", SS.scan_raw(spark, f"{root}/raw"), F.col("ordinal")), ("empty", SS.empty_chars(spark), F.col("ordinal"))]
    out = None
    for name, df, check in got:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(check).cast("long").alias("check_sum")).select(
            F.lit(name).alias("source"), "rows", "check_sum")
        out = one if out is None else out.unionByName(one)
    return out


@C.register("request_edge_cases", """
WITH e AS (SELECT event_id, props, event_id % 8 AS k FROM events),
b AS (SELECT event_id, k, CASE k WHEN 0 THEN props || ' ' || props WHEN 1 THEN props || ' trailing"' WHEN 2 THEN '{"a":1,"a":' || event_id || '}'
  WHEN 3 THEN event_id || '],[2' WHEN 4 THEN ' ' || props || chr(10) WHEN 5 THEN chr(39) || 'x' || chr(39) WHEN 6 THEN event_id || '' ELSE 'NaN' END AS body FROM e)
SELECT event_id, k IN (2, 4, 6) AS is_json,
  CASE k WHEN 0 THEN event_id * 1000 WHEN 1 THEN 9223372036854775807 WHEN 2 THEN 9223372036854775807 END AS retry_ms,
  CASE k WHEN 0 THEN 'a%FFb' WHEN 1 THEN '%E0%A4' WHEN 2 THEN 'é' WHEN 3 THEN 'a%' WHEN 4 THEN 'a+b c' WHEN 5 THEN '%C0%80' WHEN 6 THEN chr(65533) ELSE '€' END AS segment
FROM b""")
def q_request_edge_cases(spark, sf_dir):
    """P21, F15, P19/F16 on hostile input: second values, repeated keys, huge
    Retry-After seconds, escapes that are not UTF-8."""
    from quarry.operators import requests as RQ
    i, props = F.col("event_id"), F.col("props")
    pick = lambda *xs: F.element_at(F.array(*xs), (i % 8 + 1).cast("int"))
    text = i.cast("string")
    body = pick(F.concat(props, F.lit(" "), props), F.concat(props, F.lit(' trailing"')), F.concat(F.lit('{"a":1,"a":'), text, F.lit("}")),
                F.concat(text, F.lit("],[2")), F.concat(F.lit(" "), props, F.lit("\n")), F.lit("'x'"), text, F.lit("NaN"))
    retry = pick(text, F.lit("99999999999999999"), F.lit("9" * 40), F.lit("soon"), F.lit(""), F.lit("-5"), F.lit("1.5"), F.lit(None).cast("string"))
    segment = pick(*[F.lit(x) for x in ("a%FFb", "%E0%A4", "%c3%A9", "a%", "a+b%20c", "%C0%80", "%EF%BF%BD", "%E2%82%AC")])
    e = AD.table(spark, sf_dir, "events")
    return e.select("event_id", RQ.is_json(body).alias("is_json"),
                    RQ.retry_after_ms(F.create_map(F.lit("retry-after"), retry), F.lit("2024-01-01").cast("timestamp")).alias("retry_ms"),
                    K.decode_segment(segment).alias("segment"))


_bucketed: dict = {}


def _bucketed_state(spark, sf_dir):
    """The seeded state as a bucketed table, three files of results streamed
    into it in mixed order, and the stream once more from the start; staged
    once per application."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _bucketed:
        _bucketed[known] = _stage_bucketed(spark, sf_dir)
    return _bucketed[known]


def _stage_bucketed(spark, sf_dir):
    root = checkpoint_root(spark, "bucketed-state", unique=True)
    results = AD.event_results(spark, sf_dir).select("account", "character", "outcome", "attempts", "fetchedAt", "file", "seq")
    kinds = {f.name: f.dataType for f in results.schema.fields}
    seed = C._seeded(spark, sf_dir).withColumns({c: F.lit(None).cast(kinds[c]) for c in ("file", "seq")})
    table = BK.create(seed, f"{root}/state", ST.IDENTITY, 16)
    # By a hash, so that later files bring older results.
    src = C.SM.stage_files(results.withColumn("__h", F.xxhash64("seq")), f"{root}/results", 3, ["__h"])
    each = C.SM.files_a_batch(spark, src, 3)
    for run, files in (("first", each), ("again", 3 * each)):
        C.SM.incremental_buckets(spark, table, src, results.schema, f"{root}/{run}", files_per_trigger=files)
    return seed, table


@C.register("bucketed_merge", C._STATE_CTE + """
SELECT ordinal, account, "character", outcome, attempts, fetchedAt FROM merged""")
def q_bucketed_merge(spark, sf_dir):
    """J3, R1, R3 by copy on write: only buckets with results are rewritten,
    the state is never shuffled, late and repeated results change nothing."""
    _, table = _bucketed_state(spark, sf_dir)
    return BK.read(spark, table).select("ordinal", "account", "character", "outcome", "attempts", "fetchedAt")


@C.register("delta_tallies", C._STATE_CTE + """
SELECT outcome, count(*) AS lines FROM merged GROUP BY outcome""")
def q_delta_tallies(spark, sf_dir):
    """R1, A1 by deltas: the seed's tally and the signed changes since."""
    seed, table = _bucketed_state(spark, sf_dir)
    first = seed.groupBy("outcome").agg(F.count(F.lit(1)).alias("delta"))
    every = first.unionByName(BK.read_deltas(spark, table, "outcome string, delta long"))
    return every.groupBy("outcome").agg(F.sum("delta").alias("lines")).where("lines <> 0")


@C.register("bucketed_ladder", C._ROSTER_CTE + """
SELECT account, "character", class, level, rank, firstSeenAt, lastSeenAt FROM r2""")
def q_bucketed_ladder(spark, sf_dir):
    """J4 by copy on write: two captures into a bucketed roster."""
    empty = spark.createDataFrame([], "account string, character string, class string, level int, rank int, firstSeenAt string, lastSeenAt string")
    table = BK.create(empty, checkpoint_root(spark, "bucketed-roster", unique=True), ST.IDENTITY, 16)
    for first, now in ((True, C.NOW_1), (False, C.NOW_2)):
        BK.merge(spark, table, RO.latest_entries(AD.ladder_entries(spark, sf_dir, first)), RO.upsert_rows(now))
    return BK.read(spark, table)


@C.register("streaming_caps", C._quota_oracle())
def q_streaming_caps(spark, sf_dir):
    """R5 = W6: the request log as a stream of files, every line under all the
    windows of its headers. A last line, far behind, lets the others go."""
    root = checkpoint_root(spark, "streaming-caps", unique=True)
    log = AD.request_log(spark, sf_dir).select("ip", "seq", "ts", "ts_ms", "headers")
    src = C.SM.stage_files(log, f"{root}/log", 2, ["ts"])
    each = C.SM.files_a_batch(spark, src, 2)
    end = F.col("ts") + F.expr("interval 400 days")
    log.orderBy(F.desc("ts")).limit(1).select(F.lit("end of log").alias("ip"), "seq", end.alias("ts"), F.unix_millis(end).alias("ts_ms"), "headers") \
        .write.mode("append").parquet(src)
    # No line is late, in whatever order the files come.
    found = pacing.streaming_caps(spark, src, log.schema, f"{root}/out", 86_400_000, "200 days", files_per_trigger=each)
    return found.where(F.col("ip") != "end of log").select("ip", "seq", "cap", "period_ms", "hits", "violation", "earliest_ms")


#: A user is forgotten after eight quiet hours.
_QUIET_MS = 8 * 3_600_000


@C.register("streaming_keyed_state", f"""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, epoch_ms(ts) AS ms FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE ms + {_QUIET_MS} >= (SELECT epoch_ms(max(ts)) FROM events)""")
def q_streaming_keyed_state(spark, sf_dir):
    """R4 with timers: the newest event per user, users forgotten that were
    quiet at the end, the log compacted on the way and the stream started
    twice. A last line, far behind, moves the watermark to the newest event."""
    root = checkpoint_root(spark, "keyed-state", unique=True)
    ev = AD.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    src = C.SM.stage_files(ev, f"{root}/events", 4, ["ts", "event_id"])
    each = C.SM.files_a_batch(spark, src, 4)

    def run():
        # No line is late, in whatever order the files come.
        return keyed.keyed_state(spark, src, ev.schema, f"{root}/out", ["user_id"], ["ts", "event_id"], "ts", _QUIET_MS, "400 days", files_per_trigger=each, compact_every=2)

    run()
    ev.orderBy(F.desc("ts")).limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "ts": F.col("ts") + F.expr("interval 400 days")}) \
        .select(*ev.columns).write.mode("append").parquet(src)
    return keyed.read_keyed(spark, run(), ["user_id"]).where("user_id <> -1").select("user_id", "event_id", "event_type", "value")


@C.register("economy_documents", C._ECON_CTE + f""",
rep AS (SELECT league, bool_and(fetched) AS written FROM comp GROUP BY league),
body AS (SELECT league, endpoint, type, max(seq) AS b FROM resp WHERE status = 200 GROUP BY ALL)
SELECT league, endpoint, type, CASE WHEN written THEN CAST(b AS VARCHAR) ELSE 'last good' END AS body,
  CASE WHEN written THEN '{C.NOW_2}' ELSE '{C.NOW_1}' END AS "fetchedAt"
FROM comp JOIN rep USING (league) LEFT JOIN body USING (league, endpoint, type)""")
def q_economy_documents(spark, sf_dir):
    """Economy documents written over earlier ones; a league with a
    failed category keeps the document it had."""
    complete = C._completeness(spark, sf_dir)
    path = checkpoint_root(spark, "economy", unique=True)
    sinks.write_economy(complete.select("league", "endpoint", "type", F.lit("last good").alias("body")), path, fetched_at=C.NOW_1)
    good = AD.economy_responses(spark, sf_dir).where(F.col("status") == 200).groupBy("league", "endpoint", "type") \
        .agg(F.max("seq").cast("string").alias("body"))
    sinks.write_economy(good, path, C.EC.economy_league_report(complete), C.NOW_2)
    docs = spark.read.schema("fetchedAt string, categories map<string, map<string, string>>, league string").json(path)
    by_endpoint = docs.select("league", "fetchedAt", F.explode("categories").alias("endpoint", "types"))
    return by_endpoint.select("league", "endpoint", F.explode("types").alias("type", "body"), "fetchedAt")


@C.register("final_publish", C._STATE_CTE + f""",
t AS (SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'ok') AS ok,
  count(*) FILTER (WHERE outcome IN ('pending', 'retryable', 'skipped')) AS skipped,
  count(*) FILTER (WHERE outcome IN ('pending', 'retryable')) AS owed FROM merged)
SELECT total, ok, skipped, ok AS characters, '{C.NOW_2}' AS "completedAt", 'published' AS phase, 'kept' AS own,
  owed > 0 AS refused_while_pending, true AS inputs_deleted, true AS immutable FROM t""")
def q_final_publish(spark, sf_dir):
    """R2: what is left is skipped (P8), the snapshot is published once, its
    manifest settled, its inputs deleted; a second publication is refused."""
    root = checkpoint_root(spark, "final-publish", unique=True)
    doc = F.to_json(F.struct(F.struct(F.col("account").alias("class")).alias("character"), F.array().cast("array<string>").alias("items")))
    is_ok = F.col("outcome") == "ok"
    results = AD.event_results(spark, sf_dir).withColumn("characterData", F.when(is_ok, doc)) \
        .withColumn("passiveTree", F.when(is_ok, F.lit('{"hashes":[]}')))
    SS.write_state(ST.merge_results(C._seeded(spark, sf_dir), results).select(*ST.STATE_COLUMNS), f"{root}/inputs/state")
    state = SS.scan_state(spark, f"{root}/inputs/state")
    claimed = AD.table(spark, sf_dir, "customer").count()
    sinks._write_text(spark, f"{root}/manifest.json", '{"phase":"transforming","own":"kept"}')
    tree = TR.parse_tree_lines(AD.tree_lines(spark, sf_dir))

    def publish(lines):
        return sinks.final_publish(snapshot.normalise(lines, tree), AG.tally_outcomes(lines), f"{root}/published", "Standard", C.NOW_1, C.NOW_2,
                                   f"{root}/manifest.json", (f"{root}/inputs",), total_characters=claimed)

    owed = AG.tally_outcomes(state).first()
    refused = bool(owed["pending"] + owed["retryable"]) and not publish(state)["ok_to_publish"]
    gate = publish(ST.mark_remaining_skipped(state))
    if not gate["ok_to_publish"]:
        raise RuntimeError(f"refused: {gate['errors']}")
    try:
        sinks.publish_snapshot(snapshot.from_tables(spark, sf_dir), AG.tally_outcomes(snapshot.identity_state(spark, sf_dir)),
                               f"{root}/published", "Standard", C.NOW_1, mode="immutable")
        immutable = False
    except FileExistsError:
        immutable = True
    inputs, fs = sinks._fs(spark, f"{root}/inputs")
    at = sinks.current(spark, f"{root}/published")
    meta = spark.read.json(f"{at}/meta").select(F.col("totalCharacters").alias("total"), F.col("coverage.ok").alias("ok"),
                                                F.col("skippedCount").alias("skipped"), "completedAt")
    manifest = spark.read.option("wholetext", "true").text(f"{root}/manifest.json").select(
        F.get_json_object("value", "$.phase").alias("phase"), F.get_json_object("value", "$.own").alias("own"))
    rows = sinks.read_detail(spark, f"{at}/detail/characters", "characters").agg(F.count(F.lit(1)).alias("characters"))
    return meta.crossJoin(manifest).crossJoin(rows).select(  # one row each
        "*", F.lit(refused).alias("refused_while_pending"), F.lit(not fs.exists(inputs)).alias("inputs_deleted"), F.lit(immutable).alias("immutable"))


@C.register("snapshot_keys", C._INV_CTE + """
SELECT c.league, c.snapshot_id, c.category, count(*) AS keys, CAST(sum(c.size) AS BIGINT) AS bytes,
  CASE c.category WHEN 'detail' THEN 'application/vnd.apache.parquet' WHEN 'raw' THEN 'application/json' WHEN 'chunk' THEN 'application/json' WHEN 'worker-result' THEN 'application/gzip'
    WHEN 'snapshot-state' THEN 'application/gzip' ELSE '?' END AS content_type
FROM cls c JOIN man m ON m.league = c.league AND m.snapshot_id = c.snapshot_id WHERE m.phase = 'aborted' GROUP BY ALL""")
def q_snapshot_keys(spark, sf_dir):
    """The keys behind aborted snapshots, with their content types."""
    gone = AD.manifests(spark, sf_dir).where(F.col("phase") == "aborted").select("league", F.col("snapshotId").alias("snapshot_id"))
    keys = SO.snapshot_keys(C._classified(spark, sf_dir), gone)
    return keys.groupBy("league", "snapshot_id", "category", K.content_kind("key").alias("content_type")).agg(
        F.count(F.lit(1)).alias("keys"), F.sum("size").alias("bytes"))


@C.register("tree_versions", C._LEAGUES_CTE + """,
v AS (SELECT n_name AS id, '3.' || n_regionkey AS version FROM nation WHERE n_regionkey <= 2 UNION ALL SELECT 'Standard', '3.0')
SELECT act.id, v.version, (SELECT count(*) FROM act) > (SELECT count(*) FROM act JOIN v USING (id)) AS refused
FROM act JOIN v USING (id)""")
def q_tree_versions(spark, sf_dir):
    """V6: leagues with their mapped tree version; one without is a hard error."""
    active = C.EC.active_leagues(AD.league_rows(spark, sf_dir), C.NOW_ECONOMY).select("id")
    n = AD.table(spark, sf_dir, "nation")
    versions = n.where(F.col("n_regionkey") <= 2).select(F.col("n_name").alias("league"), F.concat(F.lit("3."), F.col("n_regionkey").cast("string")).alias("version")) \
        .unionByName(spark.range(1).select(F.lit(C.EC.PERMANENT_LEAGUE).alias("league"), F.lit("3.0").alias("version")))
    try:
        C.QA.tree_versions(active, versions).write.mode("overwrite").parquet(checkpoint_root(spark, "tree-versions", unique=True))
        refused = False
    except Exception as error:  # noqa: BLE001 - only the hard error is expected
        if "no tree version mapped" not in str(error):
            raise
        refused = True
    mapped = active.join(C.QA.unmapped_leagues(active, versions), "id", "left_anti")
    return C.QA.tree_versions(mapped, versions).select("id", "version", F.lit(refused).alias("refused"))


@C.register("economy_backoff", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'error' THEN 503 WHEN 'click' THEN 429 WHEN 'view' THEN 404 ELSE 200 END AS status,
  event_id // 5 % 7 AS attempt, CASE event_id % 5 WHEN 0 THEN '3' WHEN 1 THEN '120' WHEN 2 THEN 'soon' WHEN 3 THEN '0.5' END AS retry FROM events)
SELECT event_id, CASE WHEN status = 429 AND TRY_CAST(retry AS DOUBLE) IS NOT NULL THEN CAST(least(TRY_CAST(retry AS DOUBLE) * 1000, 60000) AS BIGINT)
  WHEN status = 429 OR status >= 500 THEN CAST(pow(2, attempt) * 1000 AS BIGINT) END AS wait_ms FROM e""")
def q_economy_backoff(spark, sf_dir):
    """how long each failed category fetch waits for its next attempt."""
    e, i = AD.table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.col("event_type")
    status = F.when(kind == "error", 503).when(kind == "click", 429).when(kind == "view", 404).otherwise(200)
    retry = F.element_at(F.array(F.lit("3"), F.lit("120"), F.lit("soon"), F.lit("0.5"), F.lit(None).cast("string")), (i % 5 + 1).cast("int"))
    return e.select("event_id", C.EC.economy_backoff_ms(status, F.floor(i / 5) % 7, retry).alias("wait_ms"))


@C.register("run_counters", C._INV_CTE + C._STATE_CTE.replace("\nWITH ", ",\n", 1) + """
SELECT 'merge' AS phase, 'resolved' AS counter, count(*) FILTER (WHERE outcome = 'ok') AS value FROM merged
UNION ALL SELECT 'merge', 'failed', count(*) FILTER (WHERE outcome IN ('private', 'dead')) FROM merged
UNION ALL SELECT 'merge', 'owed', count(*) FILTER (WHERE outcome IN ('pending', 'retryable')) FROM merged
UNION ALL SELECT 'merge', 'rows', count(*) FROM merged
UNION ALL SELECT 'sweep', 'swept', count(*) FROM orph UNION ALL SELECT 'sweep', 'freed', coalesce(CAST(sum(size) AS BIGINT), 0) FROM orph
UNION ALL SELECT 'sweep', 'rows', count(*) FROM orph""")
def q_run_counters(spark, sf_dir):
    """Counters of a run, each observed in the pass that writes what they
    count: characters resolved, failed and still owed; objects swept, bytes freed."""
    root = checkpoint_root(spark, "run-counters", unique=True)
    of = F.col("outcome")
    merge = SO.observed_write(C._merged(spark, sf_dir), f"{root}/merged", "merge", resolved=F.count_if(of == "ok"),
                              failed=F.count_if(of.isin("private", "dead")), owed=F.count_if(of.isin(*ST.PENDING_OUTCOMES)))
    swept = SO.orphans(C._classified(spark, sf_dir), AD.manifests(spark, sf_dir))
    sweep = SO.observed_write(swept, f"{root}/swept", "sweep", swept=F.count(F.lit(1)), freed=F.coalesce(F.sum("size"), F.lit(0)))
    rows = [(phase, name, int(n)) for phase, found in (("merge", merge), ("sweep", sweep)) for name, n in found.items()]
    return spark.createDataFrame(rows, "phase string, counter string, value long")
