"""Words of many texts at once, as 64-bit hashes, with array operations.

Words are runs of bytes other than ASCII white space, in texts whose A-Z are
taken as a-z. A word's hash is a polynomial over its bytes modulo 2**64, read
off running sums, then mixed; equal words have equal hashes, and different
ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_blank = np.zeros(256, bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint64) + np.uint64(1)
_lower[65:91] += np.uint64(32)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, bounds): the words of text i are
    ``hashes[bounds[i]:bounds[i + 1]]``; null has none."""
    texts = texts.fill_null("")
    n = len(texts)
    wide = texts.type == pa.large_string()
    ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    letter = ~_blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    starts = letter.copy()
    starts[1:] &= ~letter[:-1] | edge[1:-1]
    lasts = letter.copy()
    lasts[:-1] &= ~letter[1:] | edge[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(lasts)
    power, inverse = _power(len(data))
    sums = np.cumsum(_lower[data] * power[:len(data)], dtype=np.uint64)
    before = np.where(first > 0, sums[first - 1], np.uint64(0))
    return mixed((sums[last] - before) * inverse[first]), np.searchsorted(first, ends).astype(np.int64)


def digests_of(words: pa.StringArray) -> np.ndarray:
    """A 64-bit digest of each of ``words`` (none null or empty), polynomial over its bytes and mixed."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    power, inverse = _power(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], dtype=np.uint64)])
    return mixed((sums[ends[1:]] - sums[ends[:-1]]) * inverse[ends[:-1]]).view(np.int64)
