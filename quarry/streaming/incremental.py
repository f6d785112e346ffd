"""Structured Streaming re-expressions of the periodic republish:

* R1 ``incremental_merge``: result files arriving in a folder are appended
  to a log, one folder per micro-batch; the state is the batch merge (J3:
  last write per identity wins, by (file, seq)) of the seed and the log, read
  when it is needed. ``on_batch`` gets it after every batch: tally, publish
  an incomplete snapshot, and so on; its failure only warns.
* R1 by deltas, ``incremental_buckets``: batches go into a bucketed state by
  copy on write, and leave signed changes of the tally.
* R3 idempotence: a replayed batch replaces its own folder of the log, and
  re-merging the same result lines cannot change the state.
* R4 ``latest_state``: keyed last-write-wins as a streaming aggregate
  (``max(struct(seq, row))``) in update mode, upserted per batch.
* R5 ``streaming_quota``: hits per key per event-time window with a
  watermark bounding late data and state.

Inputs are immutable files (each result file written once); outputs are
versioned folders under a path the caller chooses, normally below the
cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.common import latest_per_key
from quarry.operators.state import merge_results, replace_lines, tally_deltas
from quarry.sources import buckets


def incremental_merge(spark: SparkSession, state: DataFrame, results_dir: str,
                      results_schema: T.StructType, out_dir: str,
                      keys: Sequence[str] = ("account", "character"),
                      order: Sequence[str] = ("file", "seq"), files_per_trigger: int = 1,
                      on_batch: Callable[[DataFrame, int], object] | None = None) -> DataFrame:
    """R1 + R3: stream result files into a log under ``out_dir`` and return
    the merged state. A restarted stream goes on behind the last committed
    batch; a batch replayed after a crash rewrites the same folder.

    Nothing of the state is rewritten per batch: a batch costs its own lines,
    and the merge runs where its result is read. ``on_batch(merged, batch)``
    is called after each batch is durable; an exception from it is reported
    as a warning, and the stream goes on."""
    log = f"{out_dir.rstrip('/')}/log"
    schema = T.StructType([*results_schema.fields, T.StructField("batch", T.LongType())])

    def merged() -> DataFrame:
        return merge_results(state, spark.read.schema(schema).parquet(log), keys, order)

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        if on_batch is not None:
            try:
                on_batch(merged(), batch_id)
            except Exception as failed:  # noqa: BLE001 - the next batch tries again
                warnings.warn(f"batch {batch_id}: {failed}", stacklevel=1)

    stream = (spark.readStream.schema(results_schema)
              .option("maxFilesPerTrigger", files_per_trigger)
              .parquet(results_dir))
    q = (stream.writeStream.foreachBatch(apply)
         .option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return merged()


def incremental_buckets(spark: SparkSession, table: str, results_dir: str, results_schema: T.StructType, out_dir: str,
                        keys: Sequence[str] = ("account", "character"), order: Sequence[str] = ("file", "seq"),
                        files_per_trigger: int = 1) -> int:
    """R1 by deltas: result files are merged batch by batch into the bucketed
    state at ``table`` (which keeps each line's last ``order``), and leave the
    change of the tally. A batch costs its own lines and the buckets they fall
    in; a batch that comes again, or an older result that comes late, changes
    nothing. Returns the number of buckets rewritten in all."""
    rewritten = 0

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal rewritten
        latest = latest_per_key(batch, list(keys), list(order))
        rewritten += buckets.merge(spark, table, latest, lambda r, c: replace_lines(r, c, keys, order),
                                   lambda r, c: tally_deltas(r, c, keys, order))["rewritten"]

    stream = spark.readStream.schema(results_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(results_dir)
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return rewritten


def latest_state(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                 keys: Sequence[str], order: Sequence[str], files_per_trigger: int = 1) -> str:
    """Last write per key over an endless file stream, as a streaming
    aggregate in update mode. Each micro-batch's updated keys are appended
    with their batch id; readers take the newest row per key. Without a
    watermark the state holds one row per key (bounded by the key space)."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    payload = [c for c in schema.fieldNames() if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], F.struct(*payload).alias("row"))
    agg = stream.groupBy(*keys).agg(F.max(packed).alias("best"))
    table = f"{out_dir.rstrip('/')}/updates"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        (batch.select(*keys, "best.row.*", F.lit(batch_id).alias("batch_id"))
         .write.mode("overwrite").parquet(f"{table}/batch={batch_id}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table


def read_latest(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of an upsert log written by ``latest_state``."""
    df = spark.read.parquet(table)
    return latest_per_key(df, list(keys), ["batch_id"]).drop("batch_id")


def streaming_quota(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                    by: str, ts: str, period: str, lateness: str, slide: str | None = None,
                    cap: int | None = None, files_per_trigger: int = 1) -> tuple[str, int]:
    """Requests per key per event-time window of ``period`` (sliding by
    ``slide``; tumbling without it), flagged ``over`` when above ``cap``. The
    watermark (``lateness``) bounds how late a line may arrive and how long
    window state is kept. Update mode with a batch-id-keyed upsert log, so
    the final counts are complete when the input is exhausted. Returns the
    log's path and how many lines came too late and were not counted."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    window = F.window(F.col(ts), period, slide) if slide else F.window(F.col(ts), period)
    counts = (stream.withWatermark(ts, lateness).groupBy(F.col(by), window.alias("w"))
              .agg(F.count(F.lit(1)).alias("hits")))
    table = f"{out_dir.rstrip('/')}/updates"
    over = F.lit(False) if cap is None else F.col("hits") > cap

    def upsert(batch: DataFrame, batch_id: int) -> None:
        (batch.select(by, F.col("w.start").alias("window_start"), "hits", over.alias("over"),
                      F.lit(batch_id).alias("batch_id"))
         .write.mode("overwrite").parquet(f"{table}/batch={batch_id}"))

    q = (counts.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return table, late


def stage_files(df: DataFrame, path: str, files: int, sort_by: Sequence[str], rows: int = 250_000) -> str:
    """Write a table as ``files`` immutable parquet files (the stream input),
    range-partitioned on ``sort_by`` so files arrive in that order. Files that
    would have more than ``rows`` rows are cut into several: a file of one row
    group is read by one task."""
    cut = max(1, -(-df.count() // (files * rows)))
    df.repartitionByRange(files * cut, *sort_by).write.mode("errorifexists").parquet(path)
    return path


def files_a_batch(spark: SparkSession, path: str, batches: int) -> int:
    """With so many files a trigger, the files under ``path`` come in ``batches`` batches."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // batches))
