"""Aggregates: outcome tallies, name/count popularity with percentages, tree
coverage. All are hash aggregates with Spark's partial (map-side) step;
global tallies produce exactly one row even for empty input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import percentage
from quarry.operators.common import with_positions
from quarry.schemas import OUTCOMES


# ------------------------------------------------------------------ A1 - A3
def tally_outcomes(df: DataFrame, col: str = "outcome",
                   domain: Sequence[str] = OUTCOMES) -> DataFrame:
    """A1: one row, one zero-filled count column per outcome (also on empty
    input, which ``pivot`` would not give)."""
    return df.agg(*[F.count_if(F.col(col) == F.lit(k)).alias(k) for k in domain])


def add_tallies(tallies: DataFrame, domain: Sequence[str] = OUTCOMES) -> DataFrame:
    """A2: roll several tally rows into one (partial + final sum)."""
    return tallies.agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in domain])


def coverage(tally: DataFrame) -> DataFrame:
    """A3: the tally with pending_of (pending + retryable) and the total."""
    return tally.select("*", (F.col("pending") + F.col("retryable")).alias("pending_of"),
                        (F.col("ok") + F.col("private") + F.col("dead") + F.col("pending")
                         + F.col("retryable") + F.col("skipped")).alias("total"))


# ------------------------------------------------------------------ A4 - A8
def name_count(df: DataFrame, name: Column | str, where: Column | None = None,
               distinct: str | None = None) -> DataFrame:
    """``(name, count)`` per non-NULL name, counting rows or, with
    ``distinct``, distinct values of that column (exact)."""
    name_col = F.col(name) if isinstance(name, str) else name
    src = df if where is None else df.where(where)
    src = src.where(name_col.isNotNull())
    cnt = F.count_distinct(distinct) if distinct else F.count(F.lit(1))
    return src.groupBy(name_col.alias("name")).agg(cnt.alias("count"))


def order_count(df: DataFrame) -> DataFrame:
    """O2: count descending, then name ascending."""
    return df.orderBy(F.desc("count"), F.asc("name"))


def count_positions(df: DataFrame, by: str = "kind") -> DataFrame:
    """O2 as a column: the row's place in its kind's order."""
    return with_positions(df, by, [F.desc("count"), F.asc("name")])


def with_percentage(df: DataFrame, total: Column | int, decimals: int = 2) -> DataFrame:
    """Add ``percentage`` = count / total (the character count, not the
    aggregate's own sum), rounded half-up; total 0 gives 0."""
    t = F.lit(total) if isinstance(total, int) else total
    return df.withColumn("percentage", percentage(F.col("count"), t, decimals))


def class_distribution(characters: DataFrame) -> DataFrame:
    """A4: characters per ladder class."""
    return name_count(characters, "class")


def skill_popularity(skills: DataFrame) -> DataFrame:
    """A5: main-skill gems."""
    return name_count(skills, "gem", where=F.col("is_main"))


def unique_usage(items: DataFrame) -> DataFrame:
    """Distinct characters per unique item name."""
    return name_count(items, "name",
                      where=(F.col("rarity") == "Unique") & (F.col("name") != ""),
                      distinct="character_key")


def keystone_usage(passives: DataFrame) -> DataFrame:
    """Allocations (not distinct characters) per keystone."""
    return name_count(passives, "node_name", where=F.col("is_keystone"))


AGGREGATES = {
    # Aggregate kind -> (source detail table, builder).
    "class_distribution": ("characters", class_distribution),
    "skill_popularity": ("skills", skill_popularity),
    "unique_usage": ("items", unique_usage),
    "keystone_usage": ("passives", keystone_usage),
}


# ------------------------------------------------------------------ A13 - A15
def coverage_rate(alloc: DataFrame, tree: DataFrame, floor: float = 0.9) -> DataFrame:
    """A13 + V5: distinct resolved / distinct allocated hashes; characters
    whose every allocation resolves / characters with passives; pass when
    the hash rate >= ``floor`` and some character has passives."""
    t = tree.select(F.col("hash").alias("node_hash")).distinct().withColumn("__hit", F.lit(True))
    marked = alloc.join(t, "node_hash", "left").withColumn("resolved", F.coalesce("__hit", F.lit(False)))
    # Both groupings in one pass: each allocation counts for its hash and its character.
    keyed = marked.select("resolved", F.explode(F.array(
        F.struct(F.lit("hash").alias("of"), F.col("node_hash").cast("string").alias("key")),
        F.struct(F.lit("character").alias("of"), F.col("character_key").alias("key")))).alias("g")).select("resolved", "g.*")
    full = keyed.groupBy("of", "key").agg(F.bool_and("resolved").alias("full"))
    is_hash = F.col("of") == "hash"
    out = full.agg(F.count_if(is_hash).alias("distinct_allocated"), F.count_if(is_hash & F.col("full")).alias("distinct_resolved"),
                   F.count_if(~is_hash).alias("characters_with_passives"),
                   F.count_if(~is_hash & F.col("full")).alias("fully_resolved_characters"))
    rate = F.when(F.col("distinct_allocated") == 0, F.lit(0.0)).otherwise(
        F.col("distinct_resolved") / F.col("distinct_allocated"))
    return (out.withColumn("resolve_rate", rate)
            .withColumn("passes", (F.col("resolve_rate") >= F.lit(floor))
                        & (F.col("characters_with_passives") > 0)))


def unresolved_topk(alloc: DataFrame, tree: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent unresolved hashes (occurrences),
    ties by hash. ``limit`` here is the feature (a top-k report): Spark runs
    it as TakeOrderedAndProject, a per-partition top-k then a merge."""
    t = tree.select(F.col("hash").alias("node_hash"))
    counted = alloc.groupBy("node_hash").agg(F.count(F.lit(1)).alias("occurrences"))
    return (counted.join(t, "node_hash", "left_anti")
            .orderBy(F.desc("occurrences"), F.asc("node_hash")).limit(k))


def row_count(df: DataFrame) -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def percentage_col(count: str, total: str, decimals: int = 2) -> Column:
    """Column form of A8 for callers that already carry the total."""
    return percentage(F.col(count), F.col(total), decimals)
