import random

import numpy as np
import pyarrow as pa
import pytest
from plain import near_duplicates, shingles

from quarry.llm import ngram_join as N
from quarry.llm.tokens import word_hashes


def text(r, n):
    return " ".join(f"w{r.randint(0, 400)}" for _ in range(n))


def edited(r, t, k):
    w = t.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"e{r.randint(0, 10 ** 6)}"
    return " ".join(w)


def test_word_hashes_split_like_the_definition():
    texts = ["", None, "a", " a  b\t", "A b", "é\u00a0x y", "\n\n", "a" * 3000 + " z"]
    hashes, bounds = word_hashes(pa.array(texts))
    assert np.diff(bounds).tolist() == [len((t or "").encode().split()) for t in texts]
    a, ab, big = hashes[bounds[2]], hashes[bounds[3]:bounds[4]], hashes[bounds[4]:bounds[5]]
    assert ab[0] == a and (ab == big).all() and len(set(hashes.tolist())) == len({w for t in texts for w in (t or "").encode().lower().split()})
    part = pa.array(["zz", *texts]).slice(1)
    assert (word_hashes(part)[0] == hashes).all()


def test_shingle_sets_have_the_plain_sizes():
    r = random.Random(9)
    texts = [None, "", "a", "a b c", "a b c d e", "A b c d E f", *(text(r, k) for k in (5, 30, 200))]
    assert [len(s) for s in N.shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_bitmap_bound_never_rules_out_a_link():
    r = random.Random(8)
    for _ in range(200):
        a = text(r, r.randint(5, 300))
        x, y = N.shingle_sets(pa.array([a, edited(r, a, r.randint(0, len(a.split()) // 20 + 1))]))
        u, v = np.frombuffer(N.bitmap(x), np.uint64), np.frombuffer(N.bitmap(y), np.uint64)
        k = min(len(u), len(v))
        differ = int(np.bitwise_count(N.folded(u, k) ^ N.folded(v, k)).sum())
        shared = len(np.intersect1d(x, y))
        assert differ <= len(x) + len(y) - 2 * shared
        if 100 * shared >= 80 * (len(x) + len(y) - shared):
            assert N.may_link(np.array([differ]), len(x), len(y), 80)[0]


@pytest.mark.parametrize("small, block, frequent", [(8, 4096, 10), (2, 5, 3)])
def test_against_all_pairs(frame, monkeypatch, small, block, frequent):
    monkeypatch.setattr(N, "FREQUENT", frequent)
    monkeypatch.setattr(N, "SMALL_TILE", small)
    monkeypatch.setattr(N, "BLOCK", block)
    r = random.Random(6)
    docs = [None, "", "  ", "a b", "A  b", "a b c", "one two three four five", "One two THREE four five"]
    docs += [text(r, r.randint(1, 60)) for _ in range(40)]
    base, passage = text(r, 120), text(r, 60)
    docs += [base] * 30 + [edited(r, base, r.choice([1, 1, 2, 3, 5])) for _ in range(60)]
    docs += [f"{text(r, r.randint(1, 40))} {passage} {text(r, r.randint(1, 40))}" for _ in range(40)]
    chain = text(r, 100)
    for _ in range(25):
        docs.append(chain)
        chain = edited(r, chain, 2)
    docs.append(text(r, 3000))
    ids = list(range(len(docs)))
    r.shuffle(ids)
    rows = list(zip(ids, docs, strict=True))
    df = frame("doc_id long, text string", rows).repartition(6)
    assert sorted(map(tuple, N.near_duplicates(df).collect())) == near_duplicates(rows)


def test_repeated_rows_shared_ids_and_empty_table(frame):
    r = random.Random(7)
    a, b = text(r, 50), text(r, 50)
    df = frame("doc_id long, text string", [(4, a), (4, a), (4, b), (9, b), (None, a), (2, None), (2, None)])
    got = sorted((x.doc_id or 0, x.n_shingles, x.component_id) for x in N.near_duplicates(df).collect())
    na, nb = len(shingles(a)), len(shingles(b))
    assert got == sorted([(4, na, 4), (4, na, 4), (4, nb, 4), (9, nb, 4), (0, na, 4), (2, 0, 2), (2, 0, 2)])
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_many_rows_that_share_a_null_id_cost_no_pairs(frame):
    r = random.Random(5)
    base = text(r, 60)
    rows = [(None, edited(r, base, 1) if k % 2 else text(r, 20)) for k in range(2000)] + [(None, base)] * 500
    got = N.near_duplicates(frame("doc_id long, text string", rows)).collect()
    assert len(got) == 2500 and all(x.component_id is None for x in got)


def test_frequent_hashes_come_last_in_prefixes():
    own = np.arange(10, dtype=np.int64)
    assert N.prefix_of(own, 80, np.array([0, 2, 77], np.int64)).tolist() == [1, 3, 4]
    assert N.prefix_of(own, 80, np.zeros(0, np.int64)).tolist() == [0, 1, 2]
    assert N.prefix_of(own[:3], 80, np.arange(5, dtype=np.int64)).tolist() == [0]


def test_frequent_hashes_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARE", 100)
    # 400 documents: beyond 40 of them is frequent.
    texts = [f"w{i} x{i} y{i} z{i} v{i}" + (" a b c d e" if i < 41 else "") + (" f g h i j" if i < 40 else "") for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string").repartition(5)
    found = N.frequent_hashes(docs, 5, "text")
    assert found.tolist() == N.shingle_sets(pa.array(["a b c d e"]))[0].tolist()
