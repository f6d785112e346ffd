"""Building blocks shared by several operators.

* ``latest_per_key``: last-write-wins per key as an aggregate (partial
  aggregation map-side, so one hot key never lands in a single task).
* ``keep_ids``: wide rows kept by their ids, where they stand.
* ``with_global_ordinal``: a dense 0-based ordinal over a total order without
  funnelling the data through one partition.
* ``with_positions``: such an ordinal within each group.
* ``with_running_total``: the sum of a column over all rows before, likewise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import checkpoint_root, ensure_checkpoint_dir, ship

def _order_key(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


#: Bitmaps of 4 KB (32,768 neighbouring ids each) up to which they are broadcast.
BROADCAST_BITMAPS = 8_192


def _has_bit(bitmap: Column, of: Column) -> Column:
    at = F.bitmap_bit_position(of)
    byte = F.conv(F.hex(bitmap.substr((F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def keep_ids(df: DataFrame, ids: DataFrame, row_id: str) -> DataFrame:
    """The rows of ``df`` whose ``row_id`` (long) is among those of ``ids``: a semi
    join that doesn't move the rows.

    The ids are written once, and their bitmaps counted. As many as can be
    broadcast (32 MB, those of 268 million dense ids) are written too and held
    against the rows in place; ids that are more or far apart are hashed, and
    the rows shuffled past them."""
    spark = df.sparkSession
    path = checkpoint_root(spark, "kept-ids", unique=True)
    ids.select(F.col(row_id).cast("long").alias(row_id)).where(F.col(row_id).isNotNull()) \
        .write.option("compression", "zstd").parquet(f"{path}/ids")
    ids = spark.read.schema(T.StructType([T.StructField(row_id, T.LongType())])).parquet(f"{path}/ids")
    numbered = ids.select(F.bitmap_bucket_number(row_id).alias("__bucket"), F.bitmap_bit_position(row_id).alias("__at"))
    if numbered.select("__bucket").distinct().count() > BROADCAST_BITMAPS:
        # Hashing the narrow ids leaves the wide rows unsorted, so they don't spill.
        return df.join(ids.hint("shuffle_hash"), row_id, "left_semi")
    # Dealt by bucket first, so that a bitmap is built once, not in every task that has an id of it.
    numbered.repartition("__bucket").groupBy("__bucket").agg(F.bitmap_construct_agg("__at").alias("__bitmap")) \
        .write.option("compression", "zstd").parquet(f"{path}/bitmaps")
    bitmaps = spark.read.schema("__bucket long, __bitmap binary").parquet(f"{path}/bitmaps")
    of = F.col(row_id).cast("long")
    return df.join(F.broadcast(bitmaps), (F.bitmap_bucket_number(of) == F.col("__bucket")) & _has_bit(F.col("__bitmap"), of), "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   row_id: str | None = None, in_place: bool = False) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order`` tuple.

    Implemented as ``max(struct(order..., row))``: a declarative aggregate
    with a map-side partial step, so a key holding a third of all rows is
    reduced to one row per input partition before the shuffle. NULL order
    values sort lowest (a non-NULL instant beats a missing one).

    With ``row_id`` (a column unique per row) the wide rows are not carried
    through the aggregate: the winning ids are found on a narrow projection
    (same skew-safe aggregate) and the rows are semi-joined on the id (no
    skew: ids are unique), with the ids hashed and the rows streamed past them.
    ``in_place`` (long ids) writes the ids at once and leaves the rows where
    they stand (``keep_ids``).
    """
    keys = list(keys)
    if row_id is not None:
        order_cols = _order_key(order)
        packed = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                          F.col(row_id).alias("__id"))
        winners = (df.select(*keys, packed.alias("__p"))
                   .groupBy(*keys).agg(F.max("__p").alias("__best"))
                   .select(F.col("__best.__id").alias(row_id)))
        if in_place:
            return keep_ids(df, winners, row_id)
        # Hashing the narrow ids leaves the wide rows unsorted, so they don't spill.
        winners = winners.hint("shuffle_hash")
        return df.join(winners, row_id, "left_semi")
    payload = [c for c in df.columns if c not in keys]
    order_cols = _order_key(order)
    packed = F.struct(
        *[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
        F.struct(*payload).alias("__row"),
    )
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    return best.select(*keys, "__best.__row.*").select(*df.columns)


def with_global_ordinal(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal",
                        partitions: int | None = None) -> DataFrame:
    """Add a 0-based ``name`` column following the total order ``order``.

    Two passes instead of an unpartitioned window: range-partition and sort
    by the order, number rows within each partition, checkpoint that once,
    count rows per partition (a tiny table, one row per partition), then
    offset each partition's local row index by the running count of the
    partitions before it. ``order`` must be a total order
    (include a unique tie-break) for the result to be deterministic.
    """
    order_cols = _order_key(order)
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition id << 33) + row index in partition
    ranged = ranged.withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33))
    # Both passes must see the same partitions: two range exchanges sample
    # independently and may cut different boundaries. A reliable checkpoint
    # (shared checkpoint folder) materialises the numbered rows once.
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, (F.col("__off") + F.col("__local")).cast("long")) \
        .drop("__pid", "__mid", "__local", "__off")


def with_positions(df: DataFrame, by: str, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add ``name``, the row's 0-based place in its group's ``order`` (a total
    order): the ordinal over all rows less that of the group's first row, so
    a group of any size is spread over the range partitions."""
    placed = with_global_ordinal(df, [by, *order], "__at")
    first = placed.groupBy(F.col(by).alias("__by")).agg(F.min("__at").alias("__first"))
    return (placed.join(first, F.col(by).eqNullSafe(F.col("__by")))
            .withColumn(name, F.col("__at") - F.col("__first")).drop("__at", "__by", "__first"))


def with_running_total(df: DataFrame, order: Sequence[Column | str], amount: str, name: str = "before",
                       partitions: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``amount`` (long, null as 0) over all rows
    before in a total ``order``.

    Rows are dealt by range and sorted; each task sums up its own, the result
    is written once, and what the partitions before hold (one row each) is
    added."""
    spark = ship(df.sparkSession)
    order_cols = _order_key(order)
    n = partitions or spark.sparkContext.defaultParallelism
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("__pid", F.spark_partition_id()))
    schema = T.StructType([*ranged.schema.fields, T.StructField("__local", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            own = batch.column(amount).cast(pa.int64()).fill_null(0).to_numpy()
            sums = np.cumsum(own) + total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - own, pa.int64())], names=[*batch.schema.names, "__local"])
            total = int(sums[-1]) if len(sums) else total

    path = checkpoint_root(spark, "running-total", unique=True)
    ranged.mapInArrow(run, schema).write.parquet(path)
    summed = spark.read.schema(schema).parquet(path)
    totals = summed.groupBy("__pid").agg(F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (summed.join(F.broadcast(offsets), "__pid").withColumn(name, F.col("__off") + F.col("__local"))
            .drop("__pid", "__off", "__local"))
