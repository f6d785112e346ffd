"""R5 as pacing: the quota audit (W6) over an endless request log.

Per key the state holds the times of the requests of one longest period and the
lines that wait for the watermark. When it has passed a line, nothing earlier can
come any more, and the line is held against every window its own headers name:
hits in the window, and whether the cap-th earlier request is less than a period
old. So several caps and periods, sliding with each request, are audited at
once, as the batch audit does over the whole log. A timer per key lets waiting
lines go and drops the state of keys that went quiet.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators.requests import rate_rules, windows_of
from quarry.session import ship


def audit_lines(past: list[int], ready: list[list], longest_ms: int) -> list[tuple]:
    """(seq, ts, cap, period, hits, violation, earliest) for the lines
    ``ready`` (ts, seq, windows), in order, behind the times ``past``."""
    times = past + [line[0] for line in ready]
    out = []
    for at, (ts, seq, windows) in enumerate(ready, len(past)):
        upto = bisect_right(times, ts)
        for cap, period in {tuple(w) for w in windows}:
            if period > longest_ms:
                raise ValueError(f"a window of {period} ms is longer than the state keeps ({longest_ms} ms)")
            earlier = times[at - cap] if at >= cap else None
            violation = earlier is not None and earlier + period > ts
            out.append((seq, ts, cap, period, upto - bisect_right(times, ts - period), violation, earlier + period if violation else None))
    return out


def _paced(by: str, longest_ms: int):
    columns = [by, "seq", "ts_ms", "cap", "period_ms", "hits", "violation", "earliest_ms"]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[str, Any] = json.loads(state.get[0]) if state.exists else {"past": [], "due": []}
        past, due = held["past"], held["due"]
        if not state.hasTimedOut:
            for frame in frames:
                due += [[int(ts), int(seq), json.loads(w)] for ts, seq, w in zip(frame["ts_ms"], frame["seq"], frame["windows"], strict=True)]
        passed = state.getCurrentWatermarkMs()
        due.sort(key=lambda line: line[:2])
        n = bisect_right([line[0] for line in due], passed)
        found = audit_lines(past, due[:n], longest_ms)
        past = [t for t in past + [line[0] for line in due[:n]] if t > passed - longest_ms]
        due = due[n:]
        if due or past:
            state.update((json.dumps({"past": past, "due": due}),))
            state.setTimeoutTimestamp(max(passed + 1, due[0][0] if due else past[-1] + longest_ms))
        elif state.exists:
            state.remove()
        if found:
            frame = pd.DataFrame([(key[0], *line) for line in found], columns=columns)
            frame["earliest_ms"] = frame["earliest_ms"].astype("Int64")
            yield frame

    return run


def streaming_caps(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str, longest_ms: int, lateness: str,
                   by: str = "ip", headers: str = "headers", files_per_trigger: int = 1) -> DataFrame:
    """Audit a stream of request files (``by``, seq, ts, ts_ms, headers) under
    the windows that each line's headers name. Columns: ``by``, seq, ts_ms, cap,
    period_ms, hits, violation, earliest_ms, one row per line and window.

    A line is put out once the watermark (``lateness`` behind the newest line)
    has passed it; one that comes later than that is not audited. No window may
    be longer than ``longest_ms``, which bounds a key's state. Each batch writes
    a folder of its own, so a replayed batch replaces it."""
    ship(spark)
    windows = F.transform(windows_of(rate_rules(F.col(headers))), lambda w: F.array(w["cap"].cast("long"), w["period_ms"]))
    lines = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
             .withWatermark("ts", lateness).select(by, "seq", "ts", "ts_ms", F.to_json(windows).alias("windows")))
    kind = f"{by} {schema[by].dataType.simpleString()}, seq long, ts_ms long, cap int, period_ms long, hits long, violation boolean, earliest_ms long"
    audited = lines.groupBy(by).applyInPandasWithState(_paced(by, longest_ms), kind, "held string", "append", GroupStateTimeout.EventTimeTimeout)
    table = f"{out_dir.rstrip('/')}/audited"

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    q = (audited.writeStream.outputMode("append").foreachBatch(append).option("checkpointLocation", f"{out_dir.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(kind).parquet(table)
