"""Connected components of an edge table, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each u of (u, v) the smallest of u and its v; summed up inside the
    tasks first, so a hub costs one row per task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the component
    being the smallest node reachable. Nodes are of any ordered type; null
    ends, loops and repeated edges are no matter; no edges give no rows.

    Alternates large-star and small-star steps: each ties a node's neighbours
    to the smallest one, until every edge points to the root of its tree. That
    takes a number of rounds logarithmic in the nodes; each round is written
    to the shared folder. Joins are on a side with one row per key, so a hub
    with most of the edges is split by the skew handling of the join."""
    tree = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct(), name)
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first())
    before, now = None, mark(tree)
    while now != before and now[0]:
        both = tree.unionByName(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both), "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = saved(large.filter(F.col("u") != F.col("v")), name)
        least = _smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        tree = saved(small.filter(F.col("u") != F.col("v")).distinct(), name)
        before, now = now, mark(tree)
    roots = tree.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
