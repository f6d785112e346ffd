"""The divergence audit against a plain version, with and without collisions of digests."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import source_divergence as S
from quarry.llm.tokens import digests_of
from plain import ASCII


def plainly(docs, least=10, top=10):
    docs = [(t or "", l or "", s or "") for t, l, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(ASCII)), s) for t, l, s in docs if l == lang]
        sources = sorted({s for _, s in own})
        df = Counter(t for terms, _ in own for t in set(terms))
        kept = sorted(t for t in df if df[t] >= least)
        counts = {s: Counter(t for terms, x in own if x == s for t in terms if df[t] >= least) for s in sources}
        every = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(sum(f(p(counts[s], t), p(counts[o], t)) for t in kept), o) for o in sources if o != s]
            terms = [(f(p(counts[s], t), p(every, t)), t) for t in kept if counts[s][t] and p(counts[s], t) > p(every, t)]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(rows) if part == "pair" or k < top]
    return sorted(out)


def some_docs(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["aé", "Bo", "co", "中", "ö", "xy"]) + rng.choice("abcdefghij") + rng.choice(["", "a", "İ", "zz"]) for _ in range(words)]
    docs = []
    for _ in range(n):
        bias = rng.randrange(words)
        docs.append((" ".join(rng.choice(vocabulary[:bias + 1]) + rng.choice(["", ".", "1", "\n", "-x"]) for _ in range(rng.randrange(30))),
                     rng.choice(["en", "de", None]), rng.choice(["a", "b", "ü", "", None, "zz"])))
    return docs + [(None, "only", "x"), ("!! 12", "only", "y"), ("few terms", "fr", "a"), (None, None, None)] + [("hot hot cold", "en", "a")] * 50


DDL = "text string, lang string, source string"


@pytest.mark.parametrize("digest", [digests_of, lambda words: digests_of(words) & 7], ids=["own", "weak"])
def test_audit_equals_the_plain_one(spark, frame, digest, monkeypatch):
    monkeypatch.setattr(S, "CELLS", 64)
    docs = some_docs(4, 250, 60)
    found = S.audit(frame(DDL, docs), digest=digest)
    assert sorted(map(tuple, found.collect())) == plainly(docs)


def test_collided_terms_that_are_rare_one_by_one_go(spark, frame):
    docs = [("aa bb", "en", "x")] * 6 + [("bb cc", "en", "y")] * 6 + [("aa", "en", "z")] * 3
    found = S.audit(frame(DDL, docs), digest=lambda words: np.zeros(len(words), np.int64))
    assert sorted(map(tuple, found.collect())) == plainly(docs)


def test_empty_table_and_no_terms(spark, frame):
    assert S.audit(frame(DDL, [])).count() == 0
    docs = [(None, "en", "a"), ("12", "en", "b"), ("", "en", "b")]
    assert sorted(map(tuple, S.audit(frame(DDL, docs)).collect())) == plainly(docs) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 7, 10**12, 5 * 10**14], np.int64)
    total = int(counts.sum())
    assert S.share(counts, total, 4).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 8) for c in counts]


def test_terms_and_digests():
    texts = pa.array(["x", "Ab1cD é_ü", "", "tail"])[1:]
    found, of = S.terms_of(texts)
    assert found.to_pylist() == ["ab", "cd", "é", "ü", "tail"] and of.tolist() == [0, 0, 0, 0, 2]
    twice = digests_of(pa.array(["z", "ab", "ba", "ab", "é"]))
    assert twice[1] == twice[3] and len(set(twice.tolist())) == 4
