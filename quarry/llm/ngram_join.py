"""N-gram Jaccard join: near-duplicate classes of documents.

A document is the set of its word 5-grams, as sorted 64-bit hashes. Two
documents link when the Jaccard similarity of their sets reaches the
threshold; classes are the components of the links.

* Documents with equal sets are one node from the start.
* Sets that link share one of their first hashes (as many as may be missing,
  and one more) in any order of all hashes. Here hashes that many of the
  documents have come last, the others go by value; so a passage that many
  documents share doesn't bring them together. Nodes with such a hash in common
  belong together, and groups with the same first node are put together as one:
  a tile, in bands of set size, in which only pairs whose sizes fit the
  threshold are looked at. Tiles are dealt by ranges of size and cut into
  blocks, so a large one is spread over tasks.
* Every node carries a bitmap signature: the parity of its hashes per bit, the
  width growing with the set. Bits that differ count elements that are in one
  set only, which bounds the overlap from above, and most pairs end here.
* What is left is verified exactly: the sorted arrays are intersected.

Large tiles don't emit all their pairs. First each member is held against one
leader that its bitmap is near to; then, with the classes known so far, what is
outside a tile's largest class is compared with the members of other classes,
in blocks. So a group of thousands of near copies costs its members, not its
pairs, and no link between two classes is left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import planned_parts, saved, small_side, text_chunks
from quarry.llm.components import connected_components
from quarry.llm.tokens import mixed, word_hashes

WORDS, PERCENT = 5, 80
#: Tiles up to this size emit all pairs that the bitmaps allow; larger ones are worked on in two rounds.
SMALL_TILE = 64
#: Members of a block: two blocks and their bitmaps are what a task holds.
BLOCK = 1024
#: A hash is frequent that more than FREQUENT documents in SHARE have. That decides the order of hashes, and so the
#: work, never the result.
SHARE, FREQUENT = 4_000, 10
#: Bytes of text that are hashed at a time; a task's arrays are some fifty times as large.
CHUNK = 500_000
#: Counters that hashes are added up in before frequent ones are counted; a power of two.
SLOTS = 1 << 18
_FACTORS = mixed(np.arange(1, 65, dtype=np.uint64))


def shingle_sets(texts: pa.StringArray, words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words``-word shingles. A
    text of fewer words is one shingle, a text without words the empty set."""
    hashes, bounds = word_hashes(texts)
    full = np.zeros(0, np.int64)
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        total = np.full(n, words, np.uint64)
        for k in range(words):
            total += hashes[k:k + n] * _FACTORS[k]
        full = mixed(total).view(np.int64)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(full[a:b - words + 1]))
        elif b > a:
            few = np.uint64(b - a) + (hashes[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([few], np.uint64)).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
    return sets


def set_id(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, percent: int) -> int:
    """So many of a set's elements, plus none, can be missing in a linked set; one more must be shared."""
    return n - (percent * n + 99) // 100 + 1


def bitmap(own: np.ndarray) -> bytes:
    """Parity bitmap, one to two bits for each element."""
    width = max(64, 1 << (len(own) - 1).bit_length())
    odd = np.bincount(own.view(np.uint64) & np.uint64(width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap (64-bit words) brought to a smaller width; parities add up."""
    while len(bits) > words:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def may_link(differ: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """False where so many differing bits rule the similarity out."""
    return (100 + percent) * differ <= (100 - percent) * (size_a + size_b)


def frequent_hashes(docs: DataFrame, words: int, text: str) -> np.ndarray:
    """Sorted hashes that more than FREQUENT documents have, or FREQUENT in
    SHARE of a larger table, counted over all documents.

    Most hashes stand in few documents, so they are not shuffled: a first pass
    adds hashes up in SLOTS counters, and the second counts those hashes one by
    one whose counter is beyond the threshold."""
    least = max(FREQUENT, docs.count() * FREQUENT // SHARE)
    texts = docs.select(docs[text].alias("text"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in text_chunks(batches, "text", CHUNK):
            tokens = np.concatenate([np.zeros(0, np.int64), *shingle_sets(batch.column("text"), words)])
            counts += np.bincount(tokens & (SLOTS - 1), minlength=SLOTS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], names=["slot", "n"])

    full = (texts.mapInArrow(slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
            .filter(F.col("n") > least).select("slot").collect())  # at most SLOTS
    counted = np.zeros(SLOTS, bool)
    counted[[r.slot for r in full]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", CHUNK):
            tokens = np.concatenate([np.zeros(0, np.int64), *shingle_sets(batch.column("text"), words)])
            tokens, n = np.unique(tokens[counted[tokens & (SLOTS - 1)]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(n, pa.int64())], names=["token", "n"])

    often = (texts.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > least).select("token"))
    # At most the hashes of SHARE documents of mean size, divided by FREQUENT.
    return np.sort(np.array([r.token for r in often.collect()], np.int64))


def prefix_of(own: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """The first hashes of a set, frequent ones last."""
    if not len(own):
        return own
    at = np.minimum(np.searchsorted(frequent, own), max(0, len(frequent) - 1))
    late = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
    return np.concatenate([own[~late], own[late]])[:prefix_length(len(own), percent)]


def signatures(docs: DataFrame, words: int, percent: int, text: str, frequent: np.ndarray) -> DataFrame:
    """(doc_id, said, row, n, node, prefix, bits) for each row of ``docs``; said is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", CHUNK):
            sets = shingle_sets(batch.column("text"), words)
            heads = [prefix_of(own, percent, frequent) for own in sets]
            offsets = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            values = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("said"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64())),
                 pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary())],
                names=["doc_id", "said", "row", "n", "node", "prefix", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64(docs[text]).alias("said"), F.monotonically_increasing_id().alias("row"), docs[text].alias("text"))
            .mapInArrow(run, f"doc_id {kind}, said long, row long, n long, node long, prefix array<long>, bits binary"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (lead, n, node, part) in that order: ``block`` numbers the
    tile's members in the task, BLOCK to a block, and the task."""
    last, seen = None, 0
    for batch in batches:
        lead = batch.column("lead").to_numpy()
        if not len(lead):
            continue
        new = np.concatenate([[lead[0] != last], lead[1:] != lead[:-1]])
        at = np.arange(len(lead)) + seen
        # Places count from the tile's first row in this task.
        first = np.maximum.accumulate(np.where(new, np.arange(len(lead)), -1))
        at = np.where(first >= 0, np.arange(len(lead)) - first, at)
        seen, last = int(at[-1]) + 1, lead[-1]
        block = (batch.column("part").to_numpy().astype(np.int64) << 32) + at // BLOCK
        yield pa.RecordBatch.from_arrays([batch.column("lead"), batch.column("node"), batch.column("n"), pa.array(block)],
                                         names=["lead", "node", "n", "block"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (token, node) in that order: (lead, node) for the nodes of each
    token that has two or more, ``lead`` being the first of them. Of a token,
    one row is held."""
    token = lead = None
    last, waiting = None, False
    out: list[tuple[int, int]] = []

    def batch_of() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["lead", "node"])
        out.clear()
        return rows

    for batch in batches:
        tokens, nodes = (batch.column(c).to_numpy() for c in ("token", "node"))
        if not len(tokens):
            continue
        # A row whose token differs from both neighbours is alone; the batch's ends are kept for the next.
        alike = np.zeros(len(tokens), bool)
        same = tokens[1:] == tokens[:-1]
        alike[1:] |= same
        alike[:-1] |= same
        alike[[0, -1]] = True
        for t, node in zip(tokens[alike].tolist(), nodes[alike].tolist(), strict=True):
            if t != token:
                token, lead, last, waiting = t, node, node, True
            elif node != last:
                if waiting:
                    out.append((lead, lead))
                    waiting = False
                out.append((lead, node))
                last = node
        if len(out) >= 20_000:
            yield batch_of()
    if out:
        yield batch_of()


class Block:
    """Members of a tile in order of size, with their bitmaps by width."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, bits: list[bytes], groups: np.ndarray):
        order = np.lexsort((nodes, sizes))
        self.nodes, self.sizes, self.groups = nodes[order], sizes[order].astype(np.int64), groups[order]
        self.bits = [np.frombuffer(bits[i], np.uint64) for i in order]
        self.widths = np.array([len(b) for b in self.bits])
        self._at: dict[int, np.ndarray] = {}

    def at(self, words: int) -> np.ndarray:
        """All bitmaps of at least ``words`` words, brought to that width (others zero)."""
        if words not in self._at:
            rows = np.zeros((len(self.bits), words), np.uint64)
            for i, b in enumerate(self.bits):
                if len(b) >= words:
                    rows[i] = folded(b, words)
            self._at[words] = rows
        return self._at[words]

    def near(self, i: int, other: Block, among: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``among`` (places in ``other``) that member i may link with."""
        n = self.sizes[i]
        m = other.sizes[among]
        among = among[(100 * np.minimum(n, m) >= percent * np.maximum(n, m))]
        found = []
        for words in np.unique(np.minimum(self.widths[i], other.widths[among])):
            part = among[np.minimum(self.widths[i], other.widths[among]) == words]
            differ = np.bitwise_count(other.at(words)[part] ^ self.at(words)[i]).sum(1, dtype=np.int64)
            found.append(part[may_link(differ, n, other.sizes[part], percent)])
        return np.concatenate(found) if found else among


def leader_pairs(block: Block, percent: int) -> list[tuple[int, int]]:
    """Pairs (leader, member): every member is tied to the first leader near
    to it or is a leader itself. The first leader is the member nearest to the
    bitwise majority of the sets of like size."""
    middle = block.sizes[len(block.sizes) // 2]
    like = np.flatnonzero((100 * np.minimum(block.sizes, middle) >= percent * np.maximum(block.sizes, middle)))
    rows = block.at(int(block.widths[like].min()))[like]
    bits = np.unpackbits(rows.view(np.uint8), axis=1)
    majority = np.packbits(2 * bits.sum(0, dtype=np.int64) > len(like)).view(np.uint64)
    first = int(like[np.bitwise_count(rows ^ majority).sum(1).argmin()])
    pairs: list[tuple[int, int]] = []
    left = np.ones(len(block.nodes), bool)
    for i in [first, *range(len(block.nodes))]:
        if left[i]:
            left[i] = False
            hit = block.near(i, block, np.flatnonzero(left), percent)
            left[hit] = False
            pairs += [(int(block.nodes[i]), int(block.nodes[j])) for j in hit]
    return pairs


def tile_pairs(block: Block, percent: int, small: int) -> list[tuple[int, int]]:
    """First round: of a small tile all pairs that may link, else the leaders' pairs."""
    if len(block.nodes) > small:
        return leader_pairs(block, percent)
    rest = np.arange(len(block.nodes))
    return [(int(block.nodes[i]), int(block.nodes[j])) for i in rest for j in block.near(i, block, rest[i + 1:], percent)]


def class_pairs(a: Block, b: Block, same: bool, percent: int) -> list[tuple[int, int]]:
    """Pairs of members of different groups that may link."""
    pairs = []
    for i in range(len(a.nodes)):
        among = np.arange(i + 1, len(a.nodes)) if same else np.arange(len(b.nodes))
        among = among[b.groups[among] != a.groups[i]]
        if len(among):
            pairs += [(int(a.nodes[i]), int(b.nodes[j])) for j in a.near(i, b, among, percent)]
    return pairs


def _pair_frame(pairs: list[tuple[int, int]]) -> pa.Table:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": a.min(1) if len(a) else a[:, 0], "b": a.max(1) if len(a) else a[:, 0]})


def _pairs_of_tiles(percent: int, small: int):
    """First round over rows (lead, block, node, n, bits) sorted by lead and block; one block is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        pairs: list[tuple[int, int]] = []

        def close() -> None:
            if len(held) > 1:
                pairs.extend(tile_pairs(_block_of(held), percent, small))
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("lead", "block", "node", "n", "bits")), strict=True):
                if held and row[:2] != held[0][:2]:
                    close()
                held.append(row)
            if len(pairs) >= 20_000:
                yield from _pair_frame(pairs).to_batches()
                pairs.clear()
        close()
        yield from _pair_frame(pairs).to_batches()

    return run


def _block_of(rows: list[tuple], groups: list[int] | None = None) -> Block:
    nodes, sizes = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
    return Block(nodes, sizes, [r[4] for r in rows], nodes if groups is None else np.array(groups, np.int64))


def _facing_pairs(percent: int):
    """Second round for two blocks of a tile (or one with itself)."""
    def run(t: pa.Table) -> pa.Table:
        rows = list(zip(*(t.column(c).to_pylist() for c in ("lead", "block", "node", "n", "bits", "class", "right")), strict=True))
        a, b = ([r for r in rows if r[6] is side] for side in (False, True))
        left = _block_of(a, [r[5] for r in a])
        return _pair_frame(class_pairs(left, _block_of(b, [r[5] for r in b]) if b else left, not b, percent))

    return run


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, text: str) -> DataFrame:
    """The pairs (a, b), a written table, that link, verified on the texts."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = saved(nodes.select("node", "doc_id", "said").join(ends, "node", "left_semi"), "jaccard-wanted")
    texts = saved(texts_of(wanted, docs, words, text), "jaccard-texts")
    return saved(verified(pairs, texts, words, percent).distinct(), "jaccard-links")


def texts_of(wanted: DataFrame, docs: DataFrame, words: int, text: str) -> DataFrame:
    """(node, text) for each of ``wanted`` (node, doc_id, said): the texts with
    that id and hash are read again and the one with the node's set is taken,
    deflated, so rows that share an id don't meet. Of repeated rows a task gives
    one; a text given by two tasks does no harm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in text_chunks(batches, "text", CHUNK):
            own = [set_id(s) for s in shingle_sets(batch.column("text"), words)]
            keep = []
            for got, node in zip(own, batch.column("node").to_pylist(), strict=True):
                keep.append(got == node and node not in seen)
                seen.update([node] if keep[-1] else [])
            found = batch.select(["node", "text"]).filter(pa.array(keep, pa.bool_()))
            packed = [zlib.compress(t.encode(), 1) for t in found.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([found.column("node"), pa.array(packed, pa.binary())], names=["node", "text"])

    side = small_side(wanted.withColumnRenamed("doc_id", "__id"), wanted)
    found = (docs.select("doc_id", docs[text].alias("text"), F.xxhash64(docs[text]).alias("__said"))
             .join(side, (F.col("__said") == F.col("said")) & F.col("doc_id").eqNullSafe(F.col("__id"))))
    return found.select("node", "text").mapInArrow(run, "node long, text binary")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b), a written table, whose sets, taken from ``texts``
    (node, text), link: exact intersection of sorted arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text_a", 500_000):
            keep = []
            sides = ([zlib.decompress(t).decode() for t in batch.column(c).to_pylist()] for c in ("text_a", "text_b"))
            for x, y in zip(*(shingle_sets(pa.array(side, pa.string()), words) for side in sides), strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Pairs are ids: sent to the texts of their first side where they are few enough.
    both = (texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).join(small_side(pairs, pairs), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id
    (the smallest doc_id among the rows reachable by links, its own included).

    Null, empty or blank texts have the empty set and link with nothing.
    Whole texts are used, however long. Repeated rows have equal sets and one
    component; rows that share only a doc_id are judged by their texts. A
    component whose ids are all null has a null id. An empty table gives no
    rows. Other columns are not read. 64-bit hashes stand for shingles and
    sets."""
    parts = planned_parts(docs)
    rows = saved(signatures(docs, words, percent, text, frequent_hashes(docs, words, text)), "jaccard-signatures")
    some = rows.filter(F.col("n") > 0)
    chosen = saved(some.groupBy("node").agg(F.min("row").alias("row"), F.min("doc_id").alias("least_id"),
                                                   F.min("n").alias("n")), "jaccard-nodes")
    nodes = some.join(small_side(chosen.select("row"), chosen), "row", "left_semi")

    posted = nodes.select(F.explode("prefix").alias("token"), "node")
    members = (posted.repartition(parts, "token").sortWithinPartitions("token", "node")
               .mapInArrow(_tiles, "lead long, node long").distinct().join(chosen.select("node", "n"), "node"))
    members = saved(members.repartitionByRange(parts, "lead", "n", "node").sortWithinPartitions("lead", "n", "node")
                    .select("lead", "n", "node", F.spark_partition_id().alias("part"))
                    .mapInArrow(_blocks, "lead long, node long, n long, block long"), "jaccard-tiles")
    bits = nodes.select("node", "bits")
    first = saved(members.join(bits, "node").select("lead", "block", "node", "n", "bits").repartition(parts, "lead", "block")
                  .sortWithinPartitions("lead", "block", "n", "node").mapInArrow(_pairs_of_tiles(percent, SMALL_TILE), "a long, b long")
                  .distinct(), "jaccard-candidates")

    # Tiles whose pairs the first round has not all seen.
    sizes = members.groupBy("lead").agg(F.count(F.lit(1)).alias("size"), F.min("block").alias("first"), F.max("block").alias("last"))
    open_tiles = sizes.filter((F.col("size") > SMALL_TILE) | (F.col("first") != F.col("last"))).select("lead")
    large = members.join(open_tiles, "lead", "left_semi")
    links = linked(first, nodes, docs, words, percent, text)

    # Those tiles once more: what is outside a tile's largest class against the members of other classes.
    found = connected_components(links, "jaccard-classes").select("node", F.col("component").alias("class"))
    grouped = large.join(found, "node", "left").withColumn("class", F.coalesce("class", "node"))
    classes = saved(grouped.groupBy("lead", "class").agg(F.count(F.lit(1)).alias("size")), "jaccard-tile-classes")
    main = classes.groupBy("lead").agg(F.max(F.struct("size", "class")).alias("main"), F.count(F.lit(1)).alias("classes"))
    main = main.filter(F.col("classes") > 1).select("lead", F.col("main.class").alias("main"))
    grouped = saved(grouped.join(main, "lead").withColumn("outside", F.col("class") != F.col("main")).drop("main"), "jaccard-grouped")
    ranges = grouped.groupBy("lead", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("outside").alias("some"))
    left = ranges.filter("some").select("lead", F.col("block").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"))
    right = ranges.select("lead", F.col("block").alias("j"), "low", "high", F.col("some").alias("some_j"))
    # Of two blocks that both have members outside, one stands on the left.
    facing = (left.join(right, "lead").filter((100 * F.col("high_i") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("low_i"))
                                              & ((F.col("i") <= F.col("j")) | ~F.col("some_j"))).select("lead", "i", "j"))
    sided = (grouped.join(facing.withColumn("block", F.col("i")), ["lead", "block"]).withColumn("right", F.lit(False))
             .unionByName(grouped.join(facing.filter(F.col("i") != F.col("j")).withColumn("block", F.col("j")), ["lead", "block"])
                          .withColumn("right", F.lit(True))))
    more = saved(sided.join(bits, "node").groupBy("lead", "i", "j").applyInArrow(_facing_pairs(percent), "a long, b long").distinct()
                 .join(first, ["a", "b"], "left_anti"), "jaccard-candidates")
    every = links.unionByName(linked(more, nodes, docs, words, percent, text))
    joined = connected_components(every, "jaccard-components")

    named = (chosen.select("node", "least_id").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = saved(named.join(least, "component").select("node", "component_id"), "jaccard-ids")
    return (rows.select("doc_id", "n", "node").join(ids, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
