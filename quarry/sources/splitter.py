"""Elements of arrays in one JSON document of any size, read by many tasks.

The document's bytes are read in ranges, in pieces that end with ``}``. Whether
a range begins inside a string, and how deep, depends on all ranges before it:
a first pass finds for either beginning how a range turns quotes and depth, the
ranges' effects are put together in order (a few numbers per range, as many as
the scan has splits), and a second pass cuts the elements. An element that goes
over the edge of ranges is put together from its pieces.

What is left of the document without the elements, its skeleton, is small; it
holds the other members and tells which array an element stood in.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_root, ship

_QUOTE, _BACKSLASH, _COMMA = 34, 92, 44
_STEP = np.zeros(256, np.int64)
_STEP[[123, 91]] = 1
_STEP[[125, 93]] = -1
#: Bytes looked at together.
CHUNK = 4_000_000


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value): the bytes between ``}``, in order within a range."""
    read = spark.read.option("lineSep", "}").text(path)
    place = read.metadataColumn("_metadata")
    return read.select(place["file_path"].alias("file"), place["file_block_start"].alias("at"), place["file_size"].alias("size"),
                       F.col("value").cast("binary").alias("value"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], bytes, bool]]:
    """((file, at, size), bytes, last): each range in chunks of whole pieces."""
    key, held, size = None, [], 0
    for batch in batches:
        for file, at, length, value in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size", "value")), strict=True):
            if key is not None and (file, at) != key[:2]:
                yield key, b"}".join([*held, b""]), True
                held, size = [], 0
            elif size >= CHUNK:
                yield key, b"}".join([*held, b""]), False
                held, size = [], 0
            key = file, at, length
            held.append(value)
            size += len(value) + 1
    if key is not None:
        yield key, b"}".join([*held, b""]), True


def _quotes(data: np.ndarray) -> np.ndarray:
    """True at quotes that are not escaped: an even run of backslashes stands before them."""
    found = data == _QUOTE
    slash = np.flatnonzero(data == _BACKSLASH)
    if len(slash):
        first = np.concatenate([[True], np.diff(slash) > 1])
        starts = slash[first]
        ends = np.append(slash[:-1][first[1:]], slash[-1])
        odd = ends[(ends - starts) % 2 == 0] + 1
        found[odd[odd < len(data)]] = False
    return found


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: per range, for a beginning outside (0) and inside (1) of a
    string, the depth gained and the last bracket opened on each depth."""
    odd, gains, opened, total = 0, [0, 0], ({}, {}), 0
    for (file, at, size), chunk, last in _ranges(batches):
        data = np.frombuffer(chunk, np.uint8)
        quotes = np.cumsum(_quotes(data))
        for begin in (0, 1):
            step = np.where((quotes + (odd ^ begin)) & 1, 0, _STEP[data])
            level = np.cumsum(step) + gains[begin]
            opens = np.flatnonzero(step == 1)[::-1]
            for depth, first in zip(*np.unique(level[opens], return_index=True), strict=True):
                opened[begin][int(depth)] = chr(data[opens[first]])
            gains[begin] = int(level[-1])
        odd, total = odd ^ int(quotes[-1] & 1), total + len(chunk)
        if last:
            yield pa.RecordBatch.from_pylist([{"file": file, "at": at, "size": size, "odd": odd, "outside": gains[0], "inside": gains[1],
                                               "opened": json.dumps(opened), "bytes": total}])
            odd, gains, opened, total = 0, [0, 0], ({}, {}), 0


def _cut(begins: dict[tuple[str, int], tuple[int, int, bool, bool]], depth: int):
    """Second pass; ``begins``: per range whether it begins in a string, its
    depth, whether its last byte is none of the file, and whether an array of
    the depth is open. Per range rows (file, at, kind, local, arrays, whole, text):
    ``skeleton`` text in order, ``element`` texts numbered from 0 by the place
    where they start in the range (-1: begun before it), with the arrays opened
    in the range up to them; ``whole`` if both ends were seen; and one ``count``
    row: elements and arrays begun in the range."""
    names = ["file", "at", "kind", "local", "arrays", "whole", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[str, Any] = {}
        for key, chunk, last in _ranges(batches):
            file, at = key[:2]
            if not state:
                inside, level, _, is_open = begins[file, at]
                state = {"inside": inside, "level": level, "open": is_open, "begun": -1, "arrays": 0, "bits": 0, "held": b"", "started": False}
            data = np.frombuffer(chunk, np.uint8)
            if last and begins[file, at][2]:
                data = data[:-1]  # the file doesn't end with the piece's end
            rows: list[tuple] = []
            within = (np.cumsum(_quotes(data)) + state["inside"]) & 1
            step = np.where(within, 0, _STEP[data])
            level = np.cumsum(step) + state["level"]
            # Where an array of that depth opens, ends, or goes on to its next element.
            opens = np.flatnonzero((step == 1) & (level == depth) & (data == 91))
            ends = np.flatnonzero((step == -1) & (level == depth - 1))
            commas = np.flatnonzero((data == _COMMA) & (within == 0) & (level == depth))
            events = sorted([(i, 0) for i in opens.tolist()] + [(i, 1) for i in commas.tolist()] + [(i, 2) for i in ends.tolist()])
            was, text = 0, bytes(data)
            for i, what in events:
                if what == 0:
                    rows.append((file, at, "skeleton", state["bits"], state["arrays"], True, text[was:i + 1]))
                    state |= {"bits": state["bits"] + 1, "open": True, "started": True, "arrays": state["arrays"] + 1, "begun": state["begun"] + 1, "held": b""}
                elif not state["open"]:
                    continue  # an object of that depth, which belongs to the skeleton
                else:
                    rows.append((file, at, "element", state["begun"] if state["started"] else -1, state["arrays"], state["started"], state["held"] + text[was:i]))
                    state["held"] = b""
                    if what == 1:
                        state |= {"started": True, "begun": state["begun"] + 1}
                    else:
                        state["open"] = False
                was = i if what == 2 else i + 1
            if state["open"]:
                state["held"] += text[was:]
            else:
                rows.append((file, at, "skeleton", state["bits"], state["arrays"], True, text[was:]))
                state["bits"] += 1
            state["inside"] = int(within[-1]) if len(data) else state["inside"]
            state["level"] = int(level[-1]) if len(data) else state["level"]
            if last:
                if state["open"]:
                    rows.append((file, at, "element", state["begun"] if state["started"] else -1, state["arrays"], False, state["held"]))
                rows.append((file, at, "count", state["begun"] + 1, state["arrays"], True, b""))
                state = {}
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


_RANGE = "file string, at long, size long, odd long, outside long, inside long, opened string, bytes long"
_ROW = "file string, at long, kind string, local long, arrays long, whole boolean, text binary"


def elements(spark: SparkSession, path: str, depth: int) -> tuple[str | None, DataFrame | None]:
    """(skeleton, elements) of the one JSON document at ``path`` (a file, a
    folder or a pattern with one file): the document with empty arrays at
    ``depth`` (1 is the outermost), and the rows (array, pos, text) of what
    stood in them; ``array`` numbers these arrays in order, ``pos`` all
    elements. Strings, escapes and brackets are followed over all ranges.

    A document that is no JSON, in itself or in an element, gives (None, None);
    so does an empty or a missing one. A task holds what stands between two
    ``}`` as a whole."""
    ship(spark)
    try:
        effects = _pieces(spark, path).mapInArrow(_effects, _RANGE)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, None
    # One row of numbers per split of the scan, which the driver lists itself to plan the scan.
    ranges = sorted(effects.collect(), key=lambda r: (r.file, r.at))
    if not ranges:
        return None, None
    if len({r.file for r in ranges}) > 1:
        raise ValueError(f"more than one document at {path}")
    extra = sum(r.bytes for r in ranges) > ranges[0].size
    begins, inside, level, bracket = {}, 0, 0, ""
    for k, r in enumerate(ranges):
        begins[r.file, r.at] = inside, level, extra and k == len(ranges) - 1, level >= depth and bracket == "["
        bracket = json.loads(r.opened)[inside].get(str(depth - level), bracket)
        inside, level = inside ^ r.odd, level + (r.inside if inside else r.outside)
    out = checkpoint_root(spark, "json-elements", unique=True)
    _pieces(spark, path).mapInArrow(_cut(begins, depth), _ROW).write.option("compression", "zstd").parquet(out)
    rows = spark.read.schema(_ROW).parquet(out)
    counts = {(r.file, r.at): (r.local, r.arrays) for r in rows.filter("kind = 'count'").select("file", "at", "local", "arrays").collect()}
    offsets, n, arrays = [], 0, 0
    for r in ranges:
        offsets.append((r.file, r.at, n, arrays))
        own = counts[r.file, r.at]
        n, arrays = n + own[0], arrays + own[1]
    places = F.broadcast(spark.createDataFrame(offsets, "file string, at long, n long, opened long"))  # a row per split
    parts = rows.filter("kind = 'skeleton'").select("at", "local", "text").orderBy("at", "local").collect()
    skeleton = b"".join(bytes(p.text) for p in parts).decode("utf-8", "replace")
    if not spark.range(1).select(F.try_parse_json(F.lit(skeleton)).isNotNull().alias("sound")).first().sound:
        return None, None
    cut = (rows.filter("kind = 'element'").join(places, ["file", "at"])
           .select((F.col("opened") + F.col("arrays") - 1).alias("array"), (F.col("n") + F.col("local")).alias("pos"), "at", "whole",
                   F.col("text").cast("string").alias("text")))
    # Only elements at the edge of a range have several pieces.
    edges = (cut.filter(~F.col("whole")).groupBy("pos").agg(F.max("array").alias("array"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "").alias("text")))
    found = (cut.filter("whole").select("array", "pos", "text").unionByName(edges.select("array", "pos", "text"))
             .withColumn("text", F.trim("text", F.lit(" \t\n\r"))))
    blank = found.filter(F.col("text") == "").select("array")
    alone = found.join(blank, "array", "left_semi").groupBy("array").agg(F.count(F.lit(1)).alias("n"))
    bad = (found.filter((F.col("text") != "") & F.try_parse_json("text").isNull()).select("array")
           .unionByName(alone.filter(F.col("n") > 1).select("array")))
    if bad.limit(1).count():
        return None, None
    return skeleton, found.filter(F.col("text") != "")


def arrays_at(document: Any, depth: int, path: tuple = ()) -> Iterator[tuple]:
    """The places of the arrays at ``depth`` of a skeleton, in order."""
    if isinstance(document, list) and depth == 1:
        yield path
    elif depth > 1 and isinstance(document, (list, dict)):
        for name, inner in enumerate(document) if isinstance(document, list) else document.items():
            yield from arrays_at(inner, depth - 1, (*path, name))
