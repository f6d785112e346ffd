"""Document-style sources: object listings (S8), manifests (S9), rosters
(S10), league rows (S13), the snapshot catalogue (S20) and snapshot meta
(S21). Each JSON document is one file. Small ones are read whole (one row per
file) and parsed on the executors, so a folder of many documents is read in
parallel; those that hold a whole league's or store's rows (S10, S13, S20) are
cut into their elements by byte ranges.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas
from quarry.functions import keys as K
from quarry.sources.splitter import arrays_at, elements


def _read_docs(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, text) per file; None when nothing exists at ``path``."""
    try:
        df = spark.read.option("wholetext", "true").text(path)
        # file_path is a URI: decode it once to get the object key back.
        return df.select(K.decode_segment(F.col("_metadata.file_path")).alias("file"),
                         F.col("value").alias("text"))
    except Exception as exc:  # a missing folder or an unmatched glob
        msg = str(exc)
        if "PATH_NOT_FOUND" in msg or "does not exist" in msg:
            return None
        raise


def _kind(v: Column, path: str) -> Column:
    """JSON kind of a field of a VARIANT value (STRING, BIGINT, OBJECT...)."""
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


def _is(v: Column, path: str, *kinds: str) -> Column:
    k = _kind(v, path)
    hit = F.lit(False)
    for kind in kinds:
        hit = hit | k.startswith(kind)
    return F.coalesce(hit & ~F.is_variant_null(F.variant_get(v, path, "variant")), F.lit(False))


def _unescape(uri: str) -> str:
    """Plain form of a qualified path string (URI escapes removed)."""
    from urllib.parse import unquote
    return unquote(uri)


NUMBER = ("BIGINT", "INT", "DECIMAL", "DOUBLE", "FLOAT", "SMALLINT", "TINYINT")


# ---------------------------------------------------------------------- S8
def scan_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``(key, size)`` for every object under ``root`` (keys relative
    to it). Only file metadata is read: the binary-file source skips the
    content when it is not selected."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = fs.makeQualified(p).toString().rstrip("/") + "/"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    # The binary-file ``path`` is the plain path string (no URI escapes).
    prefix = _unescape(prefix)
    return files.select(F.substring(F.col("path"), len(prefix) + 1, 1 << 30).alias("key"),
                        F.col("length").cast("long").alias("size"))


# ---------------------------------------------------------------------- S9
def scan_manifests(spark: SparkSession, path: str, version: int = schemas.SCHEMA_VERSION
                   ) -> DataFrame:
    """Every manifest document under ``path`` (a folder or glob);
    invalid JSON or a failed shape check drops that manifest only."""
    docs = _read_docs(spark, path)
    if docs is None:
        return spark.createDataFrame([], schemas.MANIFEST)
    v = F.try_parse_json("text")
    shaped = docs.select("file", v.alias("v")).where(
        F.col("v").isNotNull()
        & (F.try_variant_get("v", "$.schemaVersion", "int") == version)
        & _is(F.col("v"), "$.schemaVersion", *NUMBER)
        & _is(F.col("v"), "$.snapshotId", "STRING") & _is(F.col("v"), "$.league", "STRING")
        & _is(F.col("v"), "$.phase", "STRING") & _is(F.col("v"), "$.ladderCapturedAt", "STRING")
        & _is(F.col("v"), "$.totalCharacters", *NUMBER) & _is(F.col("v"), "$.outcomes", "OBJECT"))
    return shaped.select(*[
        F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in schemas.MANIFEST.fields], "file", F.col("file").alias("pos"))


def peek_manifests(spark: SparkSession, path: str) -> DataFrame:
    """S9, light: (snapshotId, schemaVersion, phase, league, file, pos) of
    every document that has a snapshot id and a phase, whatever its schema
    version; never enough to resume a snapshot, but what finding foreign ones
    takes (P16). ``league`` comes from the object key."""
    docs = _read_docs(spark, path)
    if docs is None:
        return spark.createDataFrame([], "snapshotId string, schemaVersion int, phase string, league string, file string, pos string")
    v = F.try_parse_json("text")
    shaped = docs.select("file", v.alias("v")).where(
        F.col("v").isNotNull() & _is(F.col("v"), "$.snapshotId", "STRING") & _is(F.col("v"), "$.phase", "STRING"))
    named = K.decode_segment(F.regexp_extract("file", r"/state/([^/]+)/[^/]+$", 1))
    return shaped.select(
        F.try_variant_get("v", "$.snapshotId", "string").alias("snapshotId"),
        F.try_variant_get("v", "$.schemaVersion", "int").alias("schemaVersion"),
        F.try_variant_get("v", "$.phase", "string").alias("phase"),
        F.coalesce(F.try_variant_get("v", "$.league", "string"), named).alias("league"), "file", F.col("file").alias("pos"))


# ---------------------------------------------------------------------- S10
def scan_roster(spark: SparkSession, path: str, version: int = schemas.SCHEMA_VERSION
                ) -> DataFrame:
    """Roster rows of one league document, cut by many tasks; absent,
    corrupt or written by another schema version -> an empty roster."""
    skeleton, cut = elements(spark, path, 2)
    document = json.loads(skeleton) if skeleton else None
    places = list(arrays_at(document, 2))
    if not isinstance(document, dict) or document.get("schemaVersion") != version or ("characters",) not in places:
        return spark.createDataFrame([], schemas.ROSTER)
    rows = cut.where(F.col("array") == places.index(("characters",)))
    return rows.select(F.from_json("text", schemas.ROSTER).alias("c")).select("c.*")


# ---------------------------------------------------------------------- S13
def scan_leagues(spark: SparkSession, path: str) -> DataFrame:
    """League rows (id, category_id, start_at, end_at) with their
    position, cut by many tasks; a body that is not a JSON array is an error."""
    skeleton, cut = elements(spark, path, 1)
    if skeleton is None or json.loads(skeleton) != []:
        raise ValueError(f"league body is not an array: {path}")
    return cut.select(F.from_json("text", schemas.LEAGUE_ROW).alias("r"), F.col("pos").cast("int").alias("pos")).select("r.*", "pos")


# ---------------------------------------------------------------------- S20
SNAPSHOT_ENTRY = T.StructType([
    T.StructField("schemaVersion", T.IntegerType()), T.StructField("snapshotId", T.StringType()),
    T.StructField("ladderCapturedAt", T.StringType()), T.StructField("updatedAt", T.StringType()),
    T.StructField("completedAt", T.StringType()), T.StructField("complete", T.BooleanType()),
    T.StructField("depth", T.IntegerType()), T.StructField("totalCharacters", T.IntegerType()),
    T.StructField("hasDetail", T.BooleanType())])


def scan_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """One row per (league, snapshot) of the index document; a corrupt
    document or one without a ``leagues`` array is empty. Entries of other
    schema versions are kept, and each entry's full JSON is kept verbatim in
    ``entry`` so unknown fields survive a rewrite."""
    out_t = T.StructType([T.StructField("league", T.StringType()), T.StructField("snapshot_id", T.StringType()),
                          *SNAPSHOT_ENTRY.fields, T.StructField("entry", T.StringType())])
    skeleton, cut = elements(spark, path, 4)
    document = json.loads(skeleton) if skeleton else None
    # One entry per league: the arrays of snapshots are empty in the skeleton.
    named = [(i, document["leagues"][at[1]].get("league")) for i, at in enumerate(arrays_at(document, 4))
             if isinstance(document, dict) and len(at) == 3 and at[::2] == ("leagues", "snapshots") and isinstance(document["leagues"], list)]
    if not named:
        return spark.createDataFrame([], out_t)
    leagues = spark.createDataFrame([(i, n if n is None or isinstance(n, str) else json.dumps(n)) for i, n in named], "array long, league string")
    entries = cut.join(leagues, "array").select("league", F.col("text").alias("entry"))
    return entries.select("league", F.from_json("entry", SNAPSHOT_ENTRY).alias("s"), "entry") \
        .select("league", F.col("s.snapshotId").alias("snapshot_id"), "s.*", "entry")


# ---------------------------------------------------------------------- S21
def scan_meta(spark: SparkSession, path: str) -> DataFrame:
    """(league, snapshot_id, completedAt, updatedAt) per meta document,
    the identity taken from the object key; a corrupt document gives NULL
    values rather than an error."""
    docs = _read_docs(spark, path)
    out_t = "league string, snapshot_id string, completedAt string, updatedAt string, file string"
    if docs is None:
        return spark.createDataFrame([], out_t)
    key = F.regexp_extract("file", r"(snapshots/[^/]+/[^/]+/meta\.json)$", 1)
    pattern = r"^snapshots/([^/]+)/([^/]+)/meta\.json$"
    meta_t = "struct<completedAt:string,updatedAt:string>"
    return docs.select(
        K.decode_segment(F.regexp_extract(key, pattern, 1)).alias("league"),
        F.regexp_extract(key, pattern, 2).alias("snapshot_id"),
        F.from_json("text", meta_t).alias("m"), "file").select("league", "snapshot_id", "m.completedAt",
                                                              "m.updatedAt", "file")
