"""Source divergence audit: how the sources of a language differ in their terms.

Per language the terms of enough documents are kept; smoothed shares of the kept
terms are compared between each two sources (part ``pair``) and between a source
and its language (part ``term``, the strongest terms of the source).

Strings come last. The documents are read once, into a table of counts per slice
of text with both the terms and their 64-bit digests. What is shuffled to count
them are digests and numbers. Strings are read from that table for the digests
of enough documents only: the least and the greatest one of each. Where the two
differ, terms have collided, and those few digests are counted again by string.
The audit runs on digests, and text is joined back to the rows that are put out.
All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import planned_parts, saved, small_side, text_chunks
from quarry.llm.tokens import digests_of

MIN_DOCUMENTS, TOP, SCALE = 10, 10, 1_000_000_000
#: Cells of the dense table (sources by terms) that a task holds at a time.
CELLS = 1 << 20
_term = np.zeros(256, bool)
_term[65:91] = _term[97:123] = _term[128:] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def terms_of(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """(all terms of ``texts``, runs of letters A-Z, lower-cased, and of
    characters beyond ASCII; the text that each is of)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = _term[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    first = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1]))
    last = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:]))
    bounds = np.concatenate([[0], np.cumsum(last - first + 1)]).astype(np.int32)
    letters = _lower[data[inside]]
    found = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(letters)))
    return found, np.searchsorted(ends, first, side="right") - 1


def counted(docs: DataFrame, digest: Callable[[pa.StringArray], np.ndarray], text: str) -> DataFrame:
    """(lang, source, digest, term, n, docs) per slice of text: occurrences and documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", 16_000_000):
            found, of = terms_of(batch.column("text"))
            coded = found.dictionary_encode()
            codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            if not len(codes):
                continue
            langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            groups = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            # One number for group and term, of which the first occurrence in each document is marked.
            keys = groups[of] * len(names) + codes
            order = np.lexsort((of, keys))
            keys, of = keys[order], of[order]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts = np.flatnonzero(new)
            fresh = new | np.concatenate([[True], of[1:] != of[:-1]])
            sums = np.diff(np.append(starts, len(keys)))
            documents = np.add.reduceat(fresh.astype(np.int64), starts)
            group, code = np.divmod(keys[starts], len(names))
            at = pa.array(code)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(group // len(sources.dictionary))), sources.dictionary.take(pa.array(group % len(sources.dictionary))),
                 pa.array(digest(names)).take(at), names.take(at), pa.array(sums), pa.array(documents)],
                names=["lang", "source", "digest", "term", "n", "docs"])

    rows = docs.select("lang", "source", F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, "lang string, source string, digest long, term string, n long, docs long")


def share(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), by long division in
    steps of a thousand, so that no product leaves 64 bits."""
    whole = np.int64(total) + 2 * terms
    rest, found = count + 2, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // whole
        rest = rest % whole
    return found + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _audited(langs: dict[str, tuple[int, list[str], list[int]]], top: int):
    """Over rows (lang, digest, string, source, n) sorted by term: partial sums
    for each two sources, and for each source its best terms, ties included.
    ``langs``: kept terms, sources and their totals by language."""
    names = ["lang", "source", "other", "digest", "string", "value"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    class Language:
        def __init__(self, lang: str):
            self.lang = lang
            self.terms, self.sources, totals = langs[lang]
            self.totals, self.at = np.array(totals, np.int64), {s: i for i, s in enumerate(self.sources)}
            self.sums = np.zeros((len(self.sources), len(self.sources)), np.int64)
            self.best: list[list[tuple]] = [[] for _ in self.sources]
            self.width = max(1, CELLS // len(self.sources))
            self.held: list[tuple] = []
            self.cells: tuple[list[int], list[int], list[int]] = ([], [], [])

        def add(self, term: tuple, source: str, n: int) -> None:
            if not self.held or self.held[-1] != term:
                if len(self.held) == self.width:
                    self.close()
                self.held.append(term)
            for cell, x in zip(self.cells, (self.at[source], len(self.held) - 1, n), strict=True):
                cell.append(x)

        def close(self) -> None:
            counts = np.zeros((len(self.sources), len(self.held)), np.int64)
            counts[self.cells[0], self.cells[1]] = self.cells[2]
            p = np.stack([share(c, t, self.terms) for c, t in zip(counts, self.totals, strict=True)])
            q = share(counts.sum(0), int(self.totals.sum()), self.terms)
            for i in range(len(p)):
                self.sums[i, i + 1:] += divergence(p[i], p[i + 1:]).sum(1)
                some = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                value = divergence(p[i][some], q[some])
                self.best[i] += [(int(v), *self.held[k]) for v, k in _strongest(value, some, top)]
                if len(self.best[i]) > 4 * top:
                    least = sorted((b[0] for b in self.best[i]), reverse=True)[top - 1]
                    self.best[i] = [b for b in self.best[i] if b[0] >= least]
            self.held.clear()
            for cell in self.cells:
                cell.clear()

        def rows(self) -> pa.RecordBatch:
            self.close()
            out: list[tuple] = [(self.lang, self.sources[i], self.sources[j], None, None, int(self.sums[i, j]))
                                for i in range(len(self.sources)) for j in range(i + 1, len(self.sources))]
            out += [(self.lang, s, None, digest, string, v) for s, best in zip(self.sources, self.best, strict=True) for v, digest, string in best]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Language | None = None
        for batch in batches:
            for lang, digest, string, source, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "digest", "string", "source", "n")), strict=True):
                if now is None or now.lang != lang:
                    if now is not None:
                        yield now.rows()
                    now = Language(lang)
                now.add((digest, string), source, n)
        if now is not None:
            yield now.rows()

    return run


def _strongest(value: np.ndarray, which: np.ndarray, top: int) -> Iterator[tuple[int, int]]:
    """(value, place) of the ``top`` greatest values and those equal to the last of them."""
    least = np.partition(value, -top)[-top] if len(value) > top else 0
    return zip(value[value >= least], which[value >= least], strict=True)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, text: str = "text",
          digest: Callable[[pa.StringArray], np.ndarray] = digests_of) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: per (lang, source) every other source of the language with
    the sum of the divergences over all kept terms. Part ``term``: the ``top``
    kept terms in which the source exceeds its language most. Ranks go by value
    (descending), then item in order of its bytes.

    Null text, lang and source are empty strings, which are a language and a
    source of their own. Documents without terms make groups without counts; a
    language without kept terms has pairs of value 0. Repeated rows are
    documents of their own. Texts of any length are read whole. An empty table
    gives no rows. Other columns are not read. The sources of the languages are
    gathered in the driver; the result has a row for every two of them."""
    docs = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.col(text).alias("text"))
    rows = saved(counted(docs, digest, "text"), "divergence-counts")
    # Digests and numbers only.
    sums = saved(rows.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-sums")
    enough = F.sum("docs") >= min_documents
    often = saved(sums.groupBy("lang", "digest").agg(enough.alias("enough")).filter("enough").drop("enough"), "divergence-often")
    side = small_side(often, often)
    strings = saved(rows.select("lang", "digest", "term").join(side, ["lang", "digest"], "left_semi")
                    .groupBy("lang", "digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "divergence-strings")
    collided = strings.filter(F.col("low") != F.col("high")).select("lang", "digest")
    string = F.lit(None).cast("string").alias("string")
    kept = (sums.join(side, ["lang", "digest"], "left_semi").join(collided, ["lang", "digest"], "left_anti")
            .select("lang", "digest", string, "source", "n"))
    if collided.count():
        split = saved(rows.join(collided, ["lang", "digest"], "left_semi").groupBy("lang", "source", "digest", "term")
                      .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-split")
        real = split.groupBy("lang", "digest", "term").agg(enough.alias("enough")).filter("enough").drop("enough")
        kept = kept.unionByName(split.join(real, ["lang", "digest", "term"], "left_semi")
                                .select("lang", "digest", F.col("term").alias("string"), "source", "n"))
    kept = saved(kept, "divergence-kept")

    terms = {r.lang: r.n for r in kept.select("lang", "digest", "string").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {(r.lang, r.source): r.n for r in kept.groupBy("lang", "source").agg(F.sum("n").alias("n")).collect()}
    groups = saved(docs.select("lang", "source").distinct(), "divergence-groups")
    langs: dict[str, Any] = {}
    for r in groups.orderBy("lang", "source").collect():
        _, sources, own = langs.setdefault(r.lang, (terms.get(r.lang, 0), [], []))
        sources.append(r.source)
        own.append(totals.get((r.lang, r.source), 0))

    found = saved(kept.repartition(planned_parts(kept), "lang", "digest").sortWithinPartitions("lang", "digest", "string").select(
        "lang", "digest", "string", "source", "n").mapInArrow(
            _audited(langs, top), "lang string, source string, other string, digest long, string string, value long"), "divergence-parts")
    halves = found.filter(F.col("other").isNotNull()).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = halves.unionByName(halves.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    pairs = (groups.join(groups.withColumnRenamed("source", "other"), "lang").filter(F.col("source") != F.col("other"))
             .join(both, ["lang", "source", "other"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    # Ties of the last rank are decided by text, which is joined back for the terms in question.
    each = Window.partitionBy("lang", "source")
    strongest = (found.filter(F.col("other").isNull()).withColumn("place", F.rank().over(each.orderBy(F.desc("value"))))
                 .filter(F.col("place") <= top))
    named = (strongest.join(strings, ["lang", "digest"])
             .select("lang", "source", F.lit("term").alias("part"), F.coalesce("string", "low").alias("item"), "value"))
    ranked = pairs.unionByName(named).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).cast("int"))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
