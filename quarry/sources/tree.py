"""The passive-tree dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas


def parse_tree_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Parse NDJSON node lines (hash, name, stats[], is_keystone)."""
    return lines.select(F.from_json(F.col(col), schemas.TREE_NODE).alias("n")).select("n.*")


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """Read a normalised tree file (one node per line)."""
    return spark.read.schema(schemas.TREE_NODE).option("mode", "FAILFAST").json(path)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def _truth(v: Column) -> Column:
    """Truth of a JSON value: false, 0, '' and null are false."""
    kind = _kind(v)
    return (F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(kind == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(True))
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(False))))


def normalize_tree(docs: DataFrame, doc_col: str = "doc", version_col: str = "version"
                   ) -> DataFrame:
    """Accept ``nodes`` as an array of objects or as an object keyed by
    hash; entries whose hash or key is not a number are dropped; a name that
    is not a string is '', stats that are not strings are dropped; keystone =
    the truth of ``isKeystone ?? is_keystone``. A document without ``nodes``,
    or with no node left, is an error when the result is computed. One output
    row per node, so a large tree is exploded in parallel."""
    nodes = F.variant_get(F.parse_json(F.col(doc_col)), "$.nodes", "variant")
    kind, text = _kind(nodes), F.to_json(nodes)
    as_array = F.transform(F.from_json(text, "array<variant>"), lambda n: F.struct(
        F.try_variant_get(n, "$.hash", "string").alias("key"), n.alias("n")))
    as_map = F.transform(F.map_entries(F.from_json(text, "map<string,variant>")), lambda e: F.struct(
        e["key"].alias("key"), e["value"].alias("n")))
    entries = F.when(kind.startswith("ARRAY"), as_array).when(kind.startswith("OBJECT"), as_map)
    kept = F.filter(entries, lambda e: e["key"].rlike(r"^\d+$") & _kind(e["n"]).startswith("OBJECT"))
    nothing = F.lit(None).cast("array<struct<key:string,n:variant>>")
    checked = (F.when(entries.isNull(), F.coalesce(nothing, F.raise_error(F.lit("tree JSON has no nodes array or object"))))
               .when(F.size(kept) == 0, F.coalesce(nothing, F.raise_error(F.lit("tree JSON produced no nodes"))))
               .otherwise(kept))
    rows = docs.select(F.col(version_col).alias("version"), F.explode(checked).alias("e"))
    field = lambda name: F.variant_get(F.col("e.n"), f"$.{name}", "variant")
    name, stats, camel = field("name"), field("stats"), field("isKeystone")
    strings = F.filter(F.from_json(F.to_json(stats), "array<variant>"), lambda s: _kind(s) == "STRING")
    flag = F.when(~F.is_variant_null(camel), camel)
    return rows.select(
        "version",
        F.col("e.key").cast("bigint").alias("hash"),
        F.when(_kind(name) == "STRING", F.try_variant_get(name, "$", "string")).otherwise(F.lit("")).alias("name"),
        F.when(_kind(stats).startswith("ARRAY"), F.transform(strings, lambda s: F.try_variant_get(s, "$", "string")))
        .otherwise(F.array().cast("array<string>")).alias("stats"),
        F.coalesce(_truth(F.coalesce(flag, field("is_keystone"))), F.lit(False)).alias("is_keystone"))


def pin_tree(tree_table: DataFrame, version: str) -> DataFrame:
    """The cached dimension for one version (partition pruned)."""
    return tree_table.where(F.col("version") == version).drop("version")
