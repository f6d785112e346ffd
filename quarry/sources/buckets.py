"""Keyed tables kept in buckets, changed by copy on write.

A table is a folder: rows lie in buckets by a hash of their keys, each bucket in
a folder of the version that last wrote it, and a pointer file per version names
the buckets' versions. A merge routes the changes, one row per key, by the same
hash, rewrites only the buckets that have changes and points to them. Rows of the
table are never shuffled: the changes' keys go to them as a broadcast side of a
counted size, group of buckets by group of buckets. A merge that is cut off
leaves the pointer, and so the table, as it was.

A merge may leave signed deltas of what it changed (old rows out, new rows in),
so that a total over the table is the first total and the deltas since.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import sinks

#: Changed rows whose keys are sent to the table's buckets at a time.
ROUTED_ROWS = 200_000


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _pointer(spark: SparkSession, path: str) -> dict | None:
    """The newest pointer: {version, buckets, keys, schema, at: [version of each bucket, or null]}."""
    try:
        found = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(f"{path}/pointers").select("value").collect()
    except Exception as missing:  # noqa: BLE001 - no table yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None
    return max((json.loads(r.value) for r in found), key=lambda p: p["version"], default=None)


def _point(spark: SparkSession, path: str, pointer: dict) -> None:
    sinks._write_text(spark, f"{path}/pointers/{pointer['version']:010d}.json", json.dumps(pointer))


def _write(df: DataFrame, path: str, version: str) -> list[int]:
    """Write rows with ``__bucket`` as a version; the buckets that have rows."""
    at = f"{path}/data/v{version}"
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("__bucket").parquet(at)
    schema = T.StructType([*[f for f in df.schema.fields if f.name != "__bucket"], T.StructField("__bucket", T.IntegerType())])
    found = df.sparkSession.read.schema(schema).parquet(at).select("__bucket").distinct().collect()  # at most one per bucket
    return [r["__bucket"] for r in found]


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> str:
    """Write ``df`` as a bucketed table; its keys are unique. The only time its rows are dealt by key."""
    rows = df.withColumn("__bucket", bucket_of(keys, buckets)).repartition(buckets, "__bucket")
    have = set(_write(rows, path, "0"))
    _point(df.sparkSession, path, {"version": 0, "buckets": buckets, "keys": list(keys), "schema": df.schema.json(),
                                   "at": ["0" if b in have else None for b in range(buckets)]})
    return path


def read(spark: SparkSession, path: str, only: Sequence[int] | None = None, with_bucket: bool = False) -> DataFrame:
    """The table, or some of its buckets: one scan per version still in use, pruned to its buckets."""
    pointer = _pointer(spark, path)
    schema = T.StructType.fromJson(json.loads(pointer["schema"]))
    scanned = T.StructType([*schema.fields, T.StructField("__bucket", T.IntegerType())])
    wanted = range(pointer["buckets"]) if only is None else only
    by_version: dict[str, list[int]] = {}
    for b in wanted:
        if pointer["at"][b] is not None:
            by_version.setdefault(pointer["at"][b], []).append(b)
    out = None
    for version, own in sorted(by_version.items()):
        one = spark.read.schema(scanned).parquet(f"{path}/data/v{version}").where(F.col("__bucket").isin(own))
        out = one if out is None else out.unionByName(one)
    out = spark.createDataFrame([], scanned) if out is None else out
    return out if with_bucket else out.drop("__bucket")


def merge(spark: SparkSession, path: str, changes: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame],
          deltas: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Bring ``changes``, one row per key, into the table at ``path``.

    ``merged(rows, changes)`` gives the new rows of some buckets from their rows
    and changes, both with ``__bucket``; of the changes only keys and narrow
    columns may be broadcast, and the rows may not be shuffled. ``deltas`` gets
    the same two frames and returns a few rows, kept for ``read_deltas``. Buckets are taken in
    groups of ROUTED_ROWS changes (one with more is a group of its own). Returns
    the version and the number of buckets rewritten; without changes nothing is
    written."""
    pointer = _pointer(spark, path)
    number = pointer["version"] + 1
    routed = changes.withColumn("__bucket", bucket_of(pointer["keys"], pointer["buckets"]))
    at = f"{path}/changes/v{number}"
    routed.write.mode("overwrite").option("compression", "zstd").partitionBy("__bucket").parquet(at)
    schema = T.StructType([*changes.schema.fields, T.StructField("__bucket", T.IntegerType())])
    staged = spark.read.schema(schema).parquet(at)
    counts = sorted((r["__bucket"], r["count"]) for r in staged.groupBy("__bucket").count().collect())  # at most one per bucket
    if not counts:
        return {"version": pointer["version"], "rewritten": 0}
    groups: list[list[int]] = [[]]
    held = 0
    for bucket, n in counts:
        if groups[-1] and held + n > ROUTED_ROWS:
            groups.append([])
            held = 0
        groups[-1].append(bucket)
        held += n
    places = list(pointer["at"])
    for k, group in enumerate(groups):
        version = f"{number}-{k}"
        old, own = read(spark, path, group, with_bucket=True), staged.where(F.col("__bucket").isin(group))
        have = set(_write(merged(old, own), path, version))
        if deltas is not None:
            deltas(old, own).write.mode("overwrite").parquet(f"{path}/deltas/number={number}/part={k}")
        for b in group:
            places[b] = version if b in have else None
    _point(spark, path, pointer | {"version": number, "at": places})
    return {"version": number, "rewritten": len(counts)}


def read_deltas(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The deltas of all merges that the pointer counts (one cut off is left out)."""
    pointer = _pointer(spark, path)
    if not pointer["version"]:
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(f"{schema}, number int, part int").parquet(f"{path}/deltas")
    return kept.where(F.col("number") <= pointer["version"]).drop("number", "part")
