"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its
letters' vectors, rotated by two, one and no places (binding); a text is the
sum of its trigrams' vectors (bundling), and a language prototype the sum of
its training texts, each with the same weight. A document takes the language
whose prototype has the largest cosine with it.

The random vectors are derived from the code point and a seed, so no table of
them is kept or sent. Learning sums vectors inside each task first; what is
shuffled and collected is one vector per language, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_chunks

DIMENSIONS = 2048
SEED = 20_011
UNKNOWN = "und"
#: Texts are worked on in slices of so many bytes and rows.
SLICE_BYTES, SLICE_ROWS = 1_000_000, 512


@dataclass(frozen=True)
class Prototypes:
    """Languages in ascending order, and their unit vectors as rows."""

    languages: tuple[str, ...]
    vectors: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for all else."""
    found = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            found[i] = ord(low) if len(low) == 1 else i
    return found


@lru_cache(maxsize=20_000)
def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=SEED + code)).integers(0, 2, dimensions, dtype=np.int8)
    return (2 * bits - 1).astype(np.float32)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts: texts x trigrams, letters of the trigrams: trigrams x 3 as
    indexes, code points by index). Letters are lower-cased; each run of other
    signs, and either end of a text, is one blank."""
    texts = [t or "" for t in texts]
    codes = np.frombuffer("".join(f"\0{t}\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    letters = _letters()[codes]
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    kept = letters > 0
    kept[1:] |= kept[:-1] & ~first[1:]  # the blank behind a letter
    kept |= first
    letters, owner = letters[kept], owner[kept]
    alphabet = np.flatnonzero(np.bincount(letters, minlength=1))
    index = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
    index[alphabet] = np.arange(len(alphabet))
    place, a = index[letters], len(alphabet)
    inside = owner[2:] == owner[:-2]
    key = ((place[:-2] * a + place[1:-1]) * a + place[2:])[inside]
    who = owner[2:][inside]
    if a ** 3 <= 8_000_000:
        present = np.flatnonzero(np.bincount(key, minlength=1)) if len(key) else key
        rank = np.zeros(a ** 3, np.int64)
        rank[present] = np.arange(len(present))
        inverse = rank[key]
    else:
        present, inverse = np.unique(key, return_inverse=True)
    n = len(present)
    counts = np.bincount(who * n + inverse, minlength=len(texts) * n).reshape(len(texts), n) if n else np.zeros((len(texts), 0))
    return counts.astype(np.float32), np.stack([present // (a * a), present // a % a, present % a], 1), alphabet


def bundle(weights: np.ndarray, grams: np.ndarray, alphabet: np.ndarray, dimensions: int) -> np.ndarray:
    """Sum of the trigram vectors, weighted by each row of ``weights``."""
    out = np.zeros((len(weights), dimensions), np.float32)
    if not len(grams):
        return out
    base = np.stack([_letter_vector(int(c), dimensions) for c in alphabet])
    once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
    for i in range(0, len(grams), 2048):
        part = grams[i:i + 2048]
        out += weights[:, i:i + 2048] @ (twice[part[:, 0]] * once[part[:, 1]] * base[part[:, 2]])
    return out


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, text: str = "text", lang: str = "lang") -> Prototypes:
    """Prototypes from all rows of ``docs`` with a language and a letter. No
    such row: no languages."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in text_chunks(batches, "text", SLICE_BYTES, SLICE_ROWS):
            counts, grams, alphabet = trigrams(batch.column("text").to_pylist())
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            total = counts.sum(1, keepdims=True)
            share = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
            member = np.array([[x == name for x in langs] for name in names], np.float32)
            for name, v in zip(names, bundle(member @ share, grams, alphabet, dimensions), strict=True):
                held[name] = held.get(name, 0) + v.astype(np.float64)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v.tolist() for v in held.values()])], names=["lang", "v"])

    rows = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).dropna()
    per_task = rows.mapInArrow(sums, "lang string, v array<double>")
    summed = (per_task.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))  # ``dimensions`` entries
              .select("lang", F.col("v.x").alias("v")).orderBy("lang"))
    found = [(r.lang, np.array(r.v)) for r in summed.collect()]  # a row per language
    found = [(name, v / np.linalg.norm(v)) for name, v in found if np.linalg.norm(v) > 0]
    found.sort()
    return Prototypes(tuple(n for n, _ in found), np.array([v for _, v in found], np.float32).reshape(len(found), dimensions))


def predict(docs: DataFrame, prototypes: Prototypes, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, lang_pred, score (the cosine, 0 to 1): a row per row.

    ``und`` with score 0 where the text is null, has no letter, or nothing was
    learned. Whole texts are read. Among equal cosines the first language in
    code point order wins. Repeated rows give repeated results; other columns
    are not read."""
    languages, vectors = prototypes.languages, prototypes.vectors
    dimensions = vectors.shape[1]
    column = text if text in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, column, SLICE_BYTES, SLICE_ROWS):
            names: list[str] = [UNKNOWN] * batch.num_rows
            scores = np.zeros(batch.num_rows)
            if languages:
                t = bundle(*trigrams(batch.column(column).to_pylist()), dimensions)
                norm = np.linalg.norm(t, axis=1)
                cosine = (t @ vectors.T) / np.maximum(norm, 1e-9)[:, None]
                best = cosine.argmax(1)
                for i in np.flatnonzero(norm):
                    names[i], scores[i] = languages[best[i]], min(1.0, max(0.0, float(cosine[i, best[i]])))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(names), pa.array(scores)],
                                             names=[*keep, "lang_pred", "score"])

    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    source = docs.select(*keep) if column in keep else docs.select(*keep, docs[text].alias(column))
    return source.mapInArrow(run, f"{keys}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that learning leaves out: crc32 of the id as text, mod 5, is 0 (a null id is left out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 5 == 0
