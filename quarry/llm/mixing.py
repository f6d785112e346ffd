"""Mixing sources to target weights: systematic sampling (DataFrame functions only).

Every document of a source expects ``target / source size`` copies. The
documents of a source stand in order of size, the expected copies are summed
up from the first one, one random offset per source is added, and a document
is emitted once for each whole number that its step of the sum crosses.
Standing in order of size, documents of equal size are taken at an even rate,
so the words taken from a source differ from its target by a few documents.

The prefix sum of a constant is a rank, and the rank comes from a range
partitioning of the narrow rows with one offset per partition: a source that
holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD_RE, saved
from quarry.operators.common import with_global_ordinal

WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """(source, n_docs, source_size, target, first): one row per source.

    Sources in code point order, null last, take the repeating ``weights`` of
    ``share`` times all words; no target is above ``most`` times its source,
    and the excess goes to the others by weight. With sources in order of
    limit / weight, the level left after filling the first i limits is
    greatest just where the next limit is above it, so that maximum is where
    resharing ends. ``first`` is the source's first rank."""
    per_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    named = (per_source.withColumn("place", F.row_number().over(by_name) - 1)
             .withColumn("first", F.sum("n_docs").over(by_name) - F.col("n_docs"))
             .withColumn("weight", F.get(weight, F.col("place") % len(weights)))
             .withColumn("limit", F.col("source_size") * F.lit(float(most)))
             .withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share))))
    by_fill = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    level = ((F.col("all_words") - (F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")))
             / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    return (named.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .select("source", "n_docs", "source_size", "first",
                    F.least(F.col("limit"), F.col("level") * F.col("weight")).alias("target")))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size,
    source_size, target, copies, taken.

    A null or empty text has size 0 and its copies take no words; a source
    without words has target 0. A null source is a source of its own, the
    last. Repeated rows are documents of their own. An empty table gives no
    rows. Texts are measured whole; other columns are not read."""
    sizes = saved(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0))
                              .cast("long").alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, share, most)
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = with_global_ordinal(sizes, [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")],
                                 partitions=n)
    named = targets.withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    reached = lambda k: F.floor(F.col("start") + F.col("rate") * k)
    rank = F.col("ordinal") - F.col("first")
    return (ranked.join(named, ranked["source"].eqNullSafe(named["__source"]))
            .withColumn("rate", rate).withColumn("start", offset(F.col("source"), seed))
            .withColumn("copies", (reached(rank + 1) - reached(rank)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
