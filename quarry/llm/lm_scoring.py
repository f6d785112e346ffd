"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of the orders 0 (uniform) to
``order``; the weights depend on how often the context was seen (buckets that
double) and are learned by expectation-maximisation on a deleted part of the
training documents, whose counts are taken out of the estimates meanwhile.

N-gram counts are never in one place. Documents are worked on in batches of
about ``BATCH_TOKENS`` tokens:

1. each batch sends its distinct n-grams (64-bit hashes, sorted, by hash
   range) with its own counts to the range they belong to;
2. each range adds up the counts over all batches and answers every batch
   with the totals of the n-grams it asked for, in order;
3. the answers meet the batch's token sequences again, which gives each token
   its counts.

So a frequent n-gram is one entry per batch, ranges are even whatever the
words, and what moves grows in proportion to the text. Step 3 runs twice: over
the deleted part, for a histogram of the estimates (bounded by its cells) from
which the weights are learned, and over all documents for their scores.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import planned_parts, saved, text_chunks
from quarry.llm.tokens import mixed, word_hashes

ORDER = 2
BATCH_TOKENS, BATCH_DOCS = 600_000, 50_000
#: One in so many training documents is deleted for learning the weights.
DELETED_IN = 10
#: Ratios of estimates to the uniform one are sorted into quarters of an octave for learning.
STEPS, CELLS = 4, 512
MAX_BUCKET = 40
#: Signs that stand before and after a text: their hashes. Odd hashes are words (or the end), even ones all else.
BEGIN, END = np.uint64(0xB5297A4D3F84D5B4), np.uint64(0xC2B2AE3D27D4EB4F)
_ID_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def in_training(doc_id: Column) -> Column:
    return crc(doc_id) % 7 != 2


def crc(doc_id: Column) -> Column:
    """crc32 of the id as text (of nothing, for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))


def deleted(doc_id: Column) -> Column:
    """Training documents of the deleted part."""
    return in_training(doc_id) & (F.floor(crc(doc_id) / 7) % DELETED_IN == 0)


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte planes together, deflated."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def grams(words: np.ndarray, lengths: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(hashes of the n-grams ending at each position, by order; which
    positions are tokens). A text stands as ``order - 1`` begin signs, its
    words, the end; the last begin sign is a position, the earlier are not."""
    pads = order - 1
    full = lengths + pads + 1
    ends = np.cumsum(full)
    token = np.full(int(full.sum()), BEGIN, np.uint64)
    begin = np.zeros(len(token), bool)
    for k in range(pads):
        begin[ends - full + k] = True
    token[ends - 1] = END
    place = ~begin
    place[ends - 1] = False
    token[place] = words | np.uint64(1)
    found = [token]
    for k in range(2, order + 1):
        shorter = np.concatenate([[END], found[-1][:-1]])  # the first position stands like the others behind an end
        longer = mixed(shorter * _FACTOR + token + np.uint64(k))
        found.append(longer & ~np.uint64(1))
    used = ~begin
    if pads:
        used[ends - full + pads - 1] = True
    return [g[used] for g in found], ~begin[used]


@dataclass
class Batch:
    """Documents with their tokens as indexes into the batch's words."""

    docs: list
    flags: np.ndarray  # 0: only scored, 1: training, 2: training and deleted
    lengths: np.ndarray
    words: np.ndarray  # sorted distinct hashes
    tokens: np.ndarray

    def ngrams(self, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """(sorted distinct n-grams, per order the index of each position's n-gram, which positions are tokens)."""
        levels, real = grams(self.words[self.tokens], self.lengths, order)
        keys, index = np.unique(np.concatenate(levels), return_inverse=True)
        return keys, np.split(index, order), real

    def name(self) -> bytes:
        return hashlib.blake2b(self.words.tobytes() + self.tokens.tobytes() + self.lengths.tobytes(), digest_size=8).digest()


def _batches(arrow: Iterator[pa.RecordBatch], size: int = BATCH_TOKENS) -> Iterator[tuple[int, Batch]]:
    """The batches of a partition, each with an id made of its place and its
    content; ids are odd for batches of deleted documents."""
    docs, flags, lengths, hashes, held, n = [], [], [], [], 0, 0

    def close() -> tuple[int, Batch]:
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        batch = Batch(list(docs), np.array(flags, np.int8), np.concatenate(lengths), words, tokens)
        head = f"{TaskContext.get().partitionId()}:{n}:".encode()
        name = int.from_bytes(hashlib.blake2b(head + batch.name(), digest_size=8).digest(), "little", signed=True)
        return name & ~1 | int(batch.flags.min() > 1), batch

    for part in text_chunks(arrow, "text", 1_000_000):
        found, bounds = word_hashes(part.column("text"))
        docs += part.column("doc_id").to_pylist()
        flags += part.column("flag").to_pylist()
        lengths.append(np.diff(bounds))
        hashes.append(found)
        held += len(found)
        if held >= size or len(docs) >= BATCH_DOCS:
            yield close()
            docs, flags, lengths, hashes, held, n = [], [], [], [], 0, n + 1
    if docs:
        yield close()


def _ranges(parts: int) -> np.ndarray:
    """Upper ends of the hash ranges."""
    return np.array([(k + 1) * (1 << 64) // parts - 1 for k in range(parts)], np.uint64)


def asked(docs: DataFrame, order: int, parts: int) -> DataFrame:
    """Step 1: (batch, range, keys, counts, deleted counts)."""
    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uppers = _ranges(parts)
        for name, batch in _batches(arrow):
            keys, index, _ = batch.ngrams(order)
            flag = np.repeat(batch.flags, batch.lengths + (2 if order > 1 else 1))
            counts = np.zeros(len(keys), np.int64)
            out = np.zeros(len(keys), np.int64)
            for level in index:
                counts += np.bincount(level[flag > 0], minlength=len(keys))
                out += np.bincount(level[flag > 1], minlength=len(keys))
            cuts = np.concatenate([[0], np.searchsorted(keys, uppers, "right")])
            rows = [(name, k, _pack(_steps(keys[a:b])), _pack(counts[a:b]), _pack(out[a:b]))
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                             names=["batch", "range", "keys", "counts", "deleted"])

    return docs.mapInArrow(run, "batch long, range long, keys binary, counts binary, deleted binary")


_ANSWER = "batch long, range long, counts binary, deleted binary, n long, n_deleted long, v long"


def _add_up(t: pa.Table) -> pa.Table:
    """Step 2 for a range: an answer per batch, and one row (null batch) with its share of N and V."""
    each = [np.cumsum(_unpack(x.as_py()), dtype=np.uint64) for x in t.column("keys")]
    cuts = np.cumsum([len(k) for k in each])[:-1]
    keys, index = np.unique(np.concatenate(each), return_inverse=True)
    total, out = (np.bincount(index, np.concatenate([_unpack(x.as_py()) for x in t.column(c)]).astype(np.float64), len(keys)).astype(np.int64)
                  for c in ("counts", "deleted"))
    word = (keys & np.uint64(1)) == 1
    rows = [(b, k, _pack(total[i]), _pack(out[i]), None, None, None)
            for b, k, i in zip(t.column("batch").to_pylist(), t.column("range").to_pylist(), np.split(index, cuts), strict=True)]
    rows.append((None, None, None, None, int(total[word].sum()), int(out[word].sum()), int((total[word] > 0).sum())))
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["batch", "range", "counts", "deleted", "n", "n_deleted", "v"])


def _sequences(docs: DataFrame) -> DataFrame:
    """The batches' token sequences: a row per batch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_kind = _ID_TYPES[kind]

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, b in _batches(arrow):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([b.docs], pa.list_(arrow_kind)), pa.array([b.flags.tobytes()]),
                 pa.array([_pack(b.lengths)]), pa.array([_pack(_steps(b.words))]), pa.array([_pack(b.tokens)])],
                names=["batch", "docs", "flags", "lengths", "words", "tokens"])

    return docs.mapInArrow(run, f"batch long, docs array<{kind}>, flags binary, lengths binary, words binary, tokens binary")


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct tokens in training; tokens of the deleted part."""

    n: int
    v: int
    n_deleted: int


def _counted(batch: pa.Table, answers: pa.Table, order: int, without: bool) -> tuple[Batch, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """(batch, per order the count of each token's n-gram, of its context, owner of each token)."""
    row = {c: batch.column(c)[0].as_py() for c in ("docs", "flags", "lengths", "words", "tokens")}
    b = Batch(row["docs"], np.frombuffer(row["flags"], np.int8), _unpack(row["lengths"]).astype(np.int64),
              np.cumsum(_unpack(row["words"]), dtype=np.uint64), _unpack(row["tokens"]).astype(np.int64))
    keys, index, real = b.ngrams(order)
    replies = answers.sort_by("range")
    total = np.concatenate([_unpack(x.as_py()) for x in replies.column("counts")]) if len(replies) else np.zeros(0, np.uint64)
    if len(total) != len(keys):
        raise RuntimeError("the documents were read in another order than before: batches and answers differ")
    total = total.astype(np.int64)
    if without:
        total -= np.concatenate([_unpack(x.as_py()) for x in replies.column("deleted")]).astype(np.int64)
    per_place = [total[i] for i in index]
    own = [c[real] for c in per_place]
    before = np.flatnonzero(real) - 1
    contexts = [c[before] for c in per_place[:-1]]
    return b, own, contexts, np.repeat(np.arange(len(b.docs)), b.lengths + 1)


def _ratios(own: list[np.ndarray], contexts: list[np.ndarray], n: int, v: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(estimates of order 1.. as multiples of the uniform one, bucket by frequency of the longest context)."""
    found = [own[0] * ((v + 1) / max(n, 1))]
    for c, context in zip(own[1:], contexts, strict=True):
        found.append(np.divide(c * float(v + 1), context, out=np.zeros(len(c)), where=context > 0))
    last = contexts[-1] if contexts else np.ones(len(own[0]), np.int64)
    return found, np.minimum(np.frexp(last.astype(np.float64))[1], MAX_BUCKET)


def learn(cells: list[tuple[int, ...]], order: int, rounds: int = 100) -> np.ndarray:
    """Weights (buckets x orders 0..order) by expectation-maximisation from
    (bucket, cell of each ratio, tokens). A pseudo token per order keeps every
    weight above 0; an unseen context leaves the highest order no weight, and
    a bucket without tokens takes the weights of the next lower one."""
    weights = np.full((MAX_BUCKET + 1, order + 1), 1 / (order + 1))
    data = np.array(cells, np.float64).reshape(-1, order + 2)
    for k in range(MAX_BUCKET + 1):
        own = data[data[:, 0] == k]
        if not len(own) and k > 1:
            weights[k] = weights[k - 1]
        if len(own):
            p = np.concatenate([np.ones((len(own), 1)), np.where(own[:, 1:-1] > 0, 2.0 ** ((own[:, 1:-1] - CELLS // 2) / STEPS), 0)], 1)
            for _ in range(rounds):
                share = weights[k] * p
                share *= (own[:, -1] / share.sum(1))[:, None]
                weights[k] = (share.sum(0) + 1) / (own[:, -1].sum() + order + 1)
        if k == 0 and order > 1:
            weights[0, -1] = 0
            weights[0] /= weights[0].sum()
    return weights


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score.

    Null text is empty: its one token is the end. Whole texts are counted and
    scored, however long. Repeated rows count and are scored each for itself.
    A null doc_id counts as the id of an empty text. Without training
    documents every estimate is uniform. An empty table gives no rows. Other
    columns are not read. 64-bit hashes stand for n-grams."""
    parts = planned_parts(docs)
    flag = F.when(deleted(F.col("doc_id")), F.lit(2)).when(in_training(F.col("doc_id")), F.lit(1)).otherwise(F.lit(0))
    flagged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), flag.alias("flag"))
    out, rest = flagged.filter(F.col("flag") == 2), flagged.filter(F.col("flag") < 2)

    answers = saved(asked(out, order, parts).unionByName(asked(rest, order, parts))
                    .groupBy("range").applyInArrow(_add_up, _ANSWER), "lm-counts")
    found = answers.filter(F.col("batch").isNull()).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", "n_deleted")]).first()
    totals = Totals(*found)
    replies = answers.filter(F.col("batch").isNotNull()).select("batch", "range", "counts", "deleted")

    def cells(batch: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(batch):
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        _, own, contexts, _ = _counted(batch, reply, order, without=True)
        ratios, bucket = _ratios(own, contexts, totals.n - totals.n_deleted, totals.v)
        code = bucket.astype(np.int64)
        for r in ratios:
            q = np.where(r > 0, np.clip(np.rint(STEPS * np.log2(np.maximum(r, 1e-300))) + CELLS // 2, 1, CELLS - 1), 0)
            code = code * CELLS + q.astype(np.int64)
        values, n = np.unique(code, return_counts=True)
        return pa.table({"cell": values, "n": n})

    counted = (_sequences(out).groupBy("batch").cogroup(replies.filter(F.col("batch").bitwiseAND(1) == 1).groupBy("batch"))
               .applyInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    histogram = []
    for r in counted.collect():  # bounded by the cells, whatever the corpus
        code, place = r.cell, []
        for _ in range(order):
            code, q = divmod(code, CELLS)
            place.append(q)
        histogram.append((code, *reversed(place), r.n))
    weights = learn(histogram, order) if totals.n else np.eye(1, order + 1).repeat(MAX_BUCKET + 1, 0)

    def scores(batch: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(batch):
            return empty
        b, own, contexts, owner = _counted(batch, reply, order, without=False)
        ratios, bucket = _ratios(own, contexts, totals.n, totals.v)
        w = weights[bucket]
        p = w[:, 0] + sum(w[:, k + 1] * r for k, r in enumerate(ratios))
        base = np.log10((own[0] + 1) / (totals.n + totals.v + 1))
        size = len(b.docs)
        total = lambda x: np.bincount(owner, x, size)
        return pa.table({"doc_id": pa.array(b.docs, empty.schema.field("doc_id").type), "held_out": b.flags == 0, "n_tokens": b.lengths + 1,
                         "n_known": total(own[0] > 0).astype(np.int64), "train_tokens": np.full(size, totals.n, np.int64),
                         "base_score": total(base), "score": total(np.log10(p / (totals.v + 1)))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    empty = pa.table({"doc_id": pa.array([], _ID_TYPES[kind]), "held_out": pa.array([], pa.bool_()),
                      **{c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")},
                      **{c: pa.array([], pa.float64()) for c in ("base_score", "score")}})
    return (_sequences(out).unionByName(_sequences(rest)).groupBy("batch").cogroup(replies.groupBy("batch"))
            .applyInArrow(scores, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
