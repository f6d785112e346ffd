"""Token-id files with directly addressable codes.

A segment file holds the ids of whole documents, in order. An id is cut into
chunks of bits, the lowest first: level 0 has the first chunk of every id, level
k the k-th chunk of those ids that have one. A bitmap per level says which of
its chunks continue on the next level, and a rank directory counts the bitmap's
ones before each 512 bits. The place of an id's next chunk is the rank of its
bit, so any token is read from a few bytes, without decoding a block; a run of
tokens is a run on every level. The chunk widths of a segment are those that
make it smallest, found by dynamic programming over the bit lengths of its ids.

A store is a folder: ``segments`` with the files, written by Spark's text writer
(bytes as they are, a line feed after each segment), and ``directory``, a
Parquet table with one row per segment that tells its place among all tokens.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import planned_parts, small_side, text_chunks

MAGIC = b"DAC1"
#: magic, levels, part, place in the part, documents, tokens, tokens of the part before it, bytes of the document list.
_HEAD = struct.Struct("<4sIIIQQQQ")
#: bits of a chunk, chunks on the level, whether a bitmap follows.
_LEVEL = struct.Struct("<IQI")
#: Bits of a bitmap per entry of its rank directory.
RANK_BITS = 512
#: A segment is closed with the document that reaches so many tokens.
SEGMENT_TOKENS = 1 << 22
#: Chunks that are packed at a time, a multiple of 8.
_SLICE = 1 << 17
#: Pieces of text whose ids a Python worker keeps at a time.
CACHED_PIECES = 600_000


def chunk_widths(ids: np.ndarray) -> list[int]:
    """The chunk widths with which ``ids`` take the fewest bits."""
    longest = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    lengths = np.bincount(np.frexp(ids.astype(np.float64))[1], minlength=longest + 1) if len(ids) else np.zeros(longest + 1, int)
    over = [int(lengths[x + 1:].sum()) if x else len(ids) for x in range(longest)]  # ids with a chunk from bit x on
    best: list[tuple[int, list[int]]] = [(0, [])]
    for end in range(1, longest + 1):
        best.append(min((best[start][0] + over[start] * (end - start + (end < longest)), best[start][1] + [end - start])
                        for start in range(end)))
    return best[longest][1]


def _packed(chunks: np.ndarray, width: int) -> bytes:
    """``width`` bits of each chunk, in slices of whole bytes."""
    if width in (8, 16):
        return chunks.astype(f"<u{width // 8}").tobytes()
    places = np.arange(width, dtype=np.uint32)
    return b"".join(np.packbits(((chunks[at:at + _SLICE, None] >> places) & 1).astype(np.uint8), bitorder="little").tobytes()
                    for at in range(0, len(chunks), _SLICE))


def _unpacked(data: np.ndarray, width: int, first: int, last: int) -> np.ndarray:
    """Chunks first..last of a level."""
    if width in (8, 16):
        return data.view(f"<u{width // 8}")[first:last].astype(np.uint32)
    out, places = np.empty(last - first, np.uint32), np.arange(width, dtype=np.uint32)
    for at in range(first, last, _SLICE):
        end = min(last, at + _SLICE)
        bits = np.unpackbits(data[at * width // 8:(end * width + 7) // 8], bitorder="little")
        bits = bits[at * width % 8:][:(end - at) * width].reshape(-1, width)
        out[at - first:end - first] = (bits.astype(np.uint32) << places).sum(1, dtype=np.uint32)
    return out


def segment_head(data: Any) -> dict[str, int]:
    """The counts in a segment's first bytes."""
    _, _, part, seq, n_docs, n_tokens, before, _ = _HEAD.unpack_from(data)
    return {"part": part, "seq": seq, "n_docs": n_docs, "n_tokens": n_tokens, "before": before}


def encode_segment(part: int, seq: int, before: int, docs: list[tuple[Any, int]], ids: np.ndarray) -> bytes:
    """The bytes of a segment: ``docs`` are (doc_id, tokens), ``ids`` all their tokens."""
    listed = json.dumps(docs, separators=(",", ":")).encode()
    widths = chunk_widths(ids)
    out = [_HEAD.pack(MAGIC, len(widths), part, seq, len(docs), len(ids), before, len(listed)), listed]
    rest = ids.astype(np.uint32)
    for level, width in enumerate(widths):
        more = level + 1 < len(widths)
        out += [_LEVEL.pack(width, len(rest), more), _packed(rest & np.uint32((1 << width) - 1), width)]
        if more:
            rest = rest >> np.uint32(width)
            goes_on = rest > 0
            bits = np.zeros(-(-len(goes_on) // RANK_BITS) * RANK_BITS, np.uint8)
            bits[:len(goes_on)] = goes_on
            ones = bits.reshape(-1, RANK_BITS).sum(1, dtype=np.int64)
            out += [(np.cumsum(ones) - ones).astype("<u8").tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            rest = rest[goes_on]
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


class Segment:
    """A segment's bytes, read in place."""

    def __init__(self, data: bytes, checked: bool = True):
        if data[-1:] == b"\n" and struct.unpack_from("<I", data, len(data) - 5)[0] == zlib.crc32(memoryview(data)[:-5]):
            data = data[:-1]
        elif checked and (len(data) < _HEAD.size + 4 or struct.unpack_from("<I", data, len(data) - 4)[0] != zlib.crc32(memoryview(data)[:-4])):
            raise ValueError("not a whole, sound segment")
        magic, levels, self.part, self.seq, self.n_docs, self.n_tokens, self.before, listed = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment")
        self.listed = memoryview(data)[_HEAD.size:_HEAD.size + listed]
        at, whole = _HEAD.size + listed, np.frombuffer(data, np.uint8)
        self.levels: list[tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        for _ in range(levels):
            width, n, more = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            chunks, at = whole[at:at + (n * width + 7) // 8], at + (n * width + 7) // 8
            blocks, ranks, bitmap = -(-n // RANK_BITS), None, None
            if more:
                ranks = np.frombuffer(data, "<u8", blocks, at)
                bitmap = whole[at + 8 * blocks:at + (8 + RANK_BITS // 8) * blocks]
                at += (8 + RANK_BITS // 8) * blocks
            self.levels.append((width, chunks, bitmap, ranks))

    def docs(self) -> list[list]:
        """[doc_id, tokens] for each document."""
        return json.loads(bytes(self.listed))

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // RANK_BITS
        if block == len(ranks):  # behind the last bit
            return int(ranks[-1]) + int(np.bitwise_count(bitmap[-RANK_BITS // 8:]).sum()) if block else 0
        start = block * RANK_BITS // 8
        inner = bitmap[start:i // 8]
        return int(ranks[block]) + int(np.bitwise_count(inner).sum()) + (int(bitmap[i // 8]) & ((1 << i % 8) - 1)).bit_count()

    def token(self, i: int) -> int:
        """The i-th token, from one chunk, bit and rank per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        found = shift = 0
        for width, chunks, bitmap, ranks in self.levels:
            first = i * width
            raw = int.from_bytes(chunks[first // 8:(first + width + 7) // 8].tobytes(), "little")
            found |= (raw >> first % 8 & (1 << width) - 1) << shift
            if bitmap is None or not bitmap[i // 8] >> i % 8 & 1:
                break
            i, shift = self._rank(bitmap, ranks, i), shift + width
        return found

    def tokens(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Tokens first..last (exclusive), little-endian 32-bit."""
        last = self.n_tokens if last is None else last
        parts, shift = [], 0
        for width, chunks, bitmap, ranks in self.levels:
            goes_on = None
            if bitmap is not None:
                goes_on = np.flatnonzero(np.unpackbits(bitmap[first // 8:(last + 7) // 8], bitorder="little")[first % 8:][:last - first])
            parts.append((_unpacked(chunks, width, first, last) << np.uint32(shift), goes_on))
            if goes_on is None or not len(goes_on):
                break
            first, last, shift = self._rank(bitmap, ranks, first), self._rank(bitmap, ranks, last), shift + width
        out, _ = parts[-1]
        for upper, goes_on in reversed(parts[:-1]):
            upper[goes_on] |= out
            out = upper
        return out.astype("<u4")


#: A split rule under which a run of these marks at the end of a word is split off anyway.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters in composed form that lower-casing keeps one letter.
_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+")
_TAIL = r"([A-Za-z])([.,!?;:]+)([ \t\n\r]|\z)"


class Encoder:
    """Ids of texts by a tokenizer that treats what stands between white space
    by itself: each distinct piece is encoded once and its ids are kept. Where
    the tokenizer's rules are known to lower-case and to split marks off, that
    is done beforehand, so that more pieces are alike. With ``whole`` every text
    is encoded as it is."""

    def __init__(self, tokenizer: str, end_id: int | None, whole: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one core
        self.tokenizer, self.end, self.whole = Tokenizer.from_str(tokenizer), end_id, whole
        rules = json.loads(tokenizer)
        self.folds = any(n.get("type") == "Lowercase" for n in (rules.get("normalizer") or {}).get("normalizers", []))
        self.splits = any(n.get("pattern", {}).get("Regex") == _WORD_SPLIT for n in (rules.get("pre_tokenizer") or {}).get("pretokenizers", []))
        suffix = rules["model"].get("end_of_word_suffix")
        self.marked: np.ndarray | None = None  # by id: whether it ends a word
        if suffix and self.splits and not whole:
            vocabulary = self.tokenizer.get_vocab()
            self.marked = np.zeros(max(vocabulary.values()) + 1, bool)
            self.marked[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text), each text by itself."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _learn(self, texts: list[str]) -> None:
        """Put the ids of ``texts`` behind those in the pool. Where a word's last
        id is marked, words of letters alone are encoded many at a time."""
        words = [i for i, t in enumerate(texts) if _LETTERS.fullmatch(t)] if self.marked is not None else []
        joined = [" ".join(texts[i] for i in words[at:at + 1_000]) for at in range(0, len(words), 1_000)]
        flat, _ = self._encoded(joined)
        ends = np.flatnonzero(self.marked[flat]) + 1 if len(words) else np.zeros(0, np.int64)
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(flat)):
            words, flat, ends = [], flat[:0], ends[:0]
        alone = np.ones(len(texts), bool)
        alone[words] = False
        rest, sizes = self._encoded([texts[i] for i in np.flatnonzero(alone).tolist()])
        every, starts = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        every[words], every[alone] = np.diff(ends, prepend=0), sizes
        starts[words] = len(self.pool) + ends - every[words]
        starts[alone] = len(self.pool) + len(flat) + np.cumsum(sizes) - sizes
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, every])
        self.pool = np.concatenate([self.pool, flat, rest])

    def _alike(self, texts: pa.StringArray) -> pa.StringArray:
        """``texts`` in lower case and with split marks, where all their letters are in composed form."""
        if not self.folds or not self.splits:
            return texts
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), _TAIL, r"\1 \2\3")
        return pc.if_else(pc.match_substring_regex(texts, "[^\\x{0}-\\x{2FF}]|<"), texts, plain)

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text), with the end id after each text."""
        texts = texts.fill_null("")
        if self.whole:
            self._forget()
            self._learn(texts.to_pylist())
            places, bounds = np.arange(len(texts)), np.arange(len(texts) + 1)
        else:
            pieces = pc.ascii_split_whitespace(self._alike(texts))
            bounds = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
            coded = pieces.flatten().dictionary_encode()
            names = coded.dictionary.to_numpy(zero_copy_only=False)
            if len(self.known) + len(names) > CACHED_PIECES:
                self._forget()
            at = np.fromiter(map(self.known.get, names.tolist(), repeat(-1)), np.int64, len(names))
            unknown = np.flatnonzero(at < 0)
            at[unknown] = np.arange(len(self.known), len(self.known) + len(unknown))
            new = names[unknown].tolist()
            self.known.update(zip(new, at[unknown].tolist(), strict=True))
            self._learn(new)
            places = at[coded.indices.to_numpy()]
        # One run of the pool for each piece, and for each text's end.
        end = [] if self.end is None else [self.end]
        pool, starts, sizes = np.append(self.pool, np.array(end, np.uint32)), np.append(self.starts, len(self.pool)), np.append(self.sizes, len(end))
        runs = np.insert(places, bounds[1:], len(self.starts))
        lengths = sizes[runs]
        where = np.repeat(starts[runs] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        closing = bounds[1:] + np.arange(len(texts))
        return pool[where], np.diff(np.cumsum(lengths)[closing], prepend=0)


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, end_id: int | None, whole: bool) -> Encoder:
    """The worker's encoder: later tasks take its tokenizer and the pieces it knows over."""
    return Encoder(tokenizer, end_id, whole)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, whole: bool = False,
                 text: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write the ids of ``docs`` (doc_id, text) as a store under ``path``, in
    ascending doc_id order.

    ``tokenizer`` is the tokenizer's JSON; ``end_id`` follows each document.
    Unless ``whole`` is set, texts are encoded in the pieces between ASCII white
    space, which must not change the tokenizer's result.

    A null or empty text has the end id alone. Null ids come first; rows of one
    id stand in the order in which they are read. Ids are integers or strings.
    Segments hold whole documents: a text of any length is in one (a Spark
    column holds up to 2 GB). An empty table gives a store without segments.
    Other columns are not read. Documents are dealt by (doc_id, row), so an id
    with many rows is spread over tasks."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), docs[text].alias("text"))
    parts = planned_parts(rows, 64_000_000)
    dealt = (rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "row")
             .sortWithinPartitions(F.asc_nulls_first("doc_id"), "row").withColumn("part", F.spark_partition_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq, before = _encoder(tokenizer, end_id, whole), 0, 0, 0
        listed: list[tuple[Any, int]] = []
        held: list[np.ndarray] = []
        n = 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(part, seq, before, listed, np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        for batch in batches:
            for some in text_chunks([batch], "text", 4_000_000):
                part = some.column("part")[0].as_py()
                ids, sizes = encode(some.column("text"))
                for doc, own in zip(some.column("doc_id").to_pylist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                    listed.append((doc, len(own)))
                    held.append(own)
                    n += len(own)
                    if n >= segment_tokens:
                        yield segment()
                        seq, before, n = seq + 1, before + n, 0
                        listed, held = [], []
        if listed:
            yield segment()

    # Each segment is a file: a line of bytes and the line feed.
    (dealt.select("part", "doc_id", "text").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(f"{path}/segments"))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield pa.RecordBatch.from_pylist([{"path": name} | segment_head(content.as_buffer())])

    kind = "path string, part long, seq long, n_docs long, n_tokens long, before long"
    _files(spark, path).mapInArrow(heads, kind).write.parquet(f"{path}/heads")
    found = spark.read.schema(kind).parquet(f"{path}/heads")
    # One row per part: where its tokens begin.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_ = found.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    (found.join(F.broadcast(parts_), "part").select("path", "n_docs", "n_tokens", (F.col("first") + F.col("before")).alias("start"))
     .write.parquet(f"{path}/directory"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/segments").select("path", "content")


def directory(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_docs, n_tokens, start) for each segment of a store."""
    return spark.read.schema("path string, n_docs long, n_tokens long, start long").parquet(f"{path}/directory")


def read_documents(spark: SparkSession, path: str, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document of a store: doc_id, start, n_tokens, ids_crc32 (of its ids as
    little-endian 32-bit integers) and, if wanted, ids; decoded from the files.
    One segment is held at a time. A damaged segment is an error."""
    kind = "array<long>" if with_ids else "long"
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held = Segment(content.as_py())
                ids, docs = held.tokens(), held.docs()
                sizes = np.array([n for _, n in docs], np.int64)
                starts = np.cumsum(sizes) - sizes
                own = [ids[a:a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                for at in range(0, len(docs), 10_000):
                    some = slice(at, at + 10_000)
                    shown = pa.array([x.tolist() for x in own[some]], pa.list_(pa.int64())) if with_ids else pa.nulls(len(own[some]), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own[some])), pa.array([d for d, _ in docs[some]], arrow), pa.array(starts[some]),
                         pa.array(sizes[some]), pa.array([zlib.crc32(x) for x in own[some]], pa.int64()), shown],
                        names=["path", "doc_id", "local", "n_tokens", "ids_crc32", "ids"])

    rows = _files(spark, path).mapInArrow(run, f"path string, doc_id {id_type}, local long, n_tokens long, ids_crc32 long, ids {kind}")
    places = directory(spark, path)
    found = rows.join(small_side(places.select("path", F.col("start").alias("first")), places), "path")
    return found.select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) for each row of ``positions`` (position) inside the
    store: a position finds its segment by the directory, and the token is read
    from its few bytes there. Null positions and those outside have no row."""
    bucket = SEGMENT_TOKENS
    spans = directory(spark, path).filter(F.col("n_tokens") > 0).withColumn("bucket", F.explode(F.sequence(
        F.floor(F.col("start") / bucket), F.floor((F.col("start") + F.col("n_tokens") - 1) / bucket))))
    wanted = (positions.select(F.col("position").cast("long").alias("position")).withColumn("bucket", F.floor(F.col("position") / bucket))
              .join(spans, "bucket").filter((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))
              .select("path", F.lit(None).cast("binary").alias("content"), "position", (F.col("position") - F.col("start")).alias("local")))
    files = _files(spark, path).join(wanted.select("path").distinct(), "path", "left_semi")
    both = files.select("path", "content", F.lit(None).cast("long").alias("position"), F.lit(-1).cast("long").alias("local")).unionByName(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Segment | None = None
        for batch in batches:
            out = []
            for content, position, local in zip(batch.column("content"), batch.column("position").to_pylist(), batch.column("local").to_pylist(), strict=True):
                if local < 0:
                    held = Segment(content.as_py())
                else:
                    out.append((position, held.token(local)))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([t for _, t in out], pa.int64())], names=["position", "token"])

    return both.repartition("path").sortWithinPartitions("path", "local").mapInArrow(run, "position long, token long")
