"""R4 with bounded state: the newest row per key of an endless stream, keys that
went quiet forgotten, the log of updates compacted.

Per key the state holds the newest row (by the order columns) and the time of the
last line. A line that is no newer leaves no update. A timer per key, ``ttl``
behind its last line, drops the state once the watermark has passed it and writes
a tombstone. Lines are reduced to one per key inside their task before they are
dealt by key, so a key with most of the lines costs its task little.

Each batch appends its updates in a folder of its own (a replayed batch replaces
it). Every so many batches the newest rows are written as a base; updates that
the base before it holds are then deleted, so a reader that has just listed the
table still finds its files, and the log never holds more than two bases and the
updates of twice as many batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators.common import latest_per_key
from quarry.session import ship
from quarry.sources import sinks

#: Keys that a task holds before it passes its newest lines on.
HELD_KEYS = 100_000
#: JSON that gives every value back as it was.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _ranked(schema: T.StructType, column: str) -> Column:
    """An order column as a value that JSON and Python order as Spark does."""
    kind = schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.IntegralType, T.StringType)):
        return F.col(column)
    raise ValueError(f"order column {column} is {kind.simpleString()}: whole numbers, strings, dates and times have an exact order")


def _place(rank: str) -> tuple:
    """Order columns (JSON list of one-element lists, empty for null) as a tuple, null first."""
    return tuple((0, 0) if not x else (1, x[0]) for x in json.loads(rank))


def _reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list] = {}
    columns = ["key", "rank", "row", "at"]
    for frame in frames:
        for key, rank, row, at in zip(*(frame[c] for c in columns), strict=True):
            best = held.get(key)
            if best is None:
                held[key] = [_place(rank), rank, row, at]
            else:
                if (place := _place(rank)) > best[0]:
                    best[:3] = place, rank, row
                best[3] = max(best[3], at)
        if len(held) >= HELD_KEYS:
            yield pd.DataFrame([(k, *v[1:]) for k, v in held.items()], columns=columns)
            held = {}
    if held:
        yield pd.DataFrame([(k, *v[1:]) for k, v in held.items()], columns=columns)


def _kept(ttl_ms: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], None, True)], columns=["key", "row", "gone"])
            return
        rank, row, last = state.get if state.exists else (None, None, -(1 << 62))
        newer = False
        for frame in frames:
            for other, text, at in zip(frame["rank"], frame["row"], frame["at_ms"], strict=True):
                last = max(last, int(at))
                if rank is None or _place(other) > _place(rank):
                    rank, row, newer = other, text, True
        state.update((rank, row, last))
        state.setTimeoutTimestamp(max(last + ttl_ms, state.getCurrentWatermarkMs() + 1))
        if newer:
            yield pd.DataFrame([(key[0], row, False)], columns=["key", "row", "gone"])

    return run


def keyed_state(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str, keys: Sequence[str], order: Sequence[str],
                ts: str, ttl_ms: int, lateness: str, files_per_trigger: int = 1, compact_every: int = 8) -> str:
    """Stream the files of ``source_dir`` into the newest row per key, by
    ``order``; returns the table for ``read_keyed``. A stream that is started
    again goes on behind its last batch.

    A key is forgotten when the watermark (``lateness`` behind the newest
    ``ts``) is more than ``ttl_ms`` past its last line; a line that comes after
    that starts it anew. Lines older than the watermark, and lines without a
    time, are left out. Null keys are a key; of lines equal in all order
    columns the first one read stays."""
    ship(spark)
    payload = [c for c in schema.fieldNames() if c not in keys]
    at = F.col(ts).cast("timestamp")
    rank = F.concat(F.lit("["), F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit("[]")).otherwise(F.to_json(F.array(_ranked(schema, c)))) for c in order]), F.lit("]"))
    lines = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir).where(F.col(ts).isNotNull())
             .select(F.to_json(F.struct(*keys), _EXACT).alias("key"), rank.alias("rank"), F.to_json(F.struct(*payload), _EXACT).alias("row"), at.alias("at")))
    reduced = (lines.mapInPandas(_reduce, "key string, rank string, row string, at timestamp").withWatermark("at", lateness)
               .select("key", "rank", "row", "at", F.unix_millis("at").alias("at_ms")))
    newest = reduced.groupBy("key").applyInPandasWithState(_kept(ttl_ms), "key string, row string, gone boolean", "rank string, row string, last long", "update",
                                                           GroupStateTimeout.EventTimeTimeout)
    table = f"{out_dir.rstrip('/')}/keyed"
    kinds = [T.StructType([schema[c] for c in names]) for names in (keys, payload)]

    def append(batch: DataFrame, batch_id: int) -> None:
        typed = batch.select(F.from_json("key", kinds[0], _EXACT).alias("k"), F.from_json("row", kinds[1], _EXACT).alias("r"), "gone").select("k.*", "r.*", "gone")
        typed.write.mode("overwrite").parquet(f"{table}/updates/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(spark, table, keys, batch_id)

    q = (newest.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table


def _numbers(spark: SparkSession, folder: str, done: bool = False) -> list[int]:
    """The numbers of the folders ``name=number``, rising; with ``done`` of those that were written to the end."""
    path, fs = sinks._fs(spark, folder)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if "=" in s.getPath().getName()]
    return sorted(int(p.getName().partition("=")[2]) for p in found if not done or fs.exists(sinks._fs(spark, f"{p.toString()}/_SUCCESS")[0]))


def _rows(spark: SparkSession, table: str, upto: int | None = None) -> DataFrame | None:
    """The newest base before ``upto`` and the updates behind it (to ``upto``, included)."""
    bases = [b for b in _numbers(spark, f"{table}/base", done=True) if upto is None or b < upto]
    updates = [b for b in _numbers(spark, f"{table}/updates", done=True) if (not bases or b > bases[-1]) and (upto is None or b <= upto)]
    places = [(b, f"{table}/base/upto={b}") for b in bases[-1:]] + [(b, f"{table}/updates/batch={b}") for b in updates]
    out = None
    for number, place in places:
        one = spark.read.parquet(place).withColumn("__batch", F.lit(number))
        out = one if out is None else out.unionByName(one)
    return out


def compact(spark: SparkSession, table: str, keys: Sequence[str], upto: int) -> None:
    """Write the newest rows up to a batch as a base, tombstones left out, and
    delete what the base before it already holds."""
    rows = _rows(spark, table, upto)
    latest_per_key(rows, list(keys), ["__batch"]).where(~F.col("gone")).drop("__batch") \
        .write.mode("overwrite").parquet(f"{table}/base/upto={upto}")
    before = [b for b in _numbers(spark, f"{table}/base", done=True) if b < upto]
    if before:
        old = [f"{table}/base/upto={b}" for b in before[:-1]] + [f"{table}/updates/batch={b}" for b in _numbers(spark, f"{table}/updates") if b <= before[-1]]
        for place in old:
            path, fs = sinks._fs(spark, place)
            fs.delete(path, True)


def read_keyed(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key that is not forgotten; before the first batch an error, as there is no schema yet."""
    rows = _rows(spark, table)
    if rows is None:
        raise FileNotFoundError(f"no batch of {table} has been written")
    return latest_per_key(rows, list(keys), ["__batch"]).where(~F.col("gone")).drop("__batch", "gone")
