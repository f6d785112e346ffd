import math
import random
import zlib
from collections import Counter

import pytest

from quarry.llm import lm_scoring as L

DOCS = []
_r = random.Random(4)
for _i in range(400):
    _w = ["the", "cat", "sat", "on", "a", "mat", "und", "École", "ZEBRA", f"rare{_i}"]
    DOCS.append((_i, " ".join(_w[(k * 7 + _i) % 10] if _r.random() < 0.7 else _r.choice(_w) for k in range(_r.randint(0, 40)))))
DOCS += [(1000, None), (1001, ""), (1002, " \n "), (1003, "x" * 50_000), (7, DOCS[7][1]), (None, "the cat")]


def plain(docs, order):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    part = {}
    for i, _ in docs:
        c = zlib.crc32(str(i).encode()) if i is not None else 0
        part[i] = 0 if c % 7 == 2 else 2 if c // 7 % 10 == 0 else 1
    padded = lambda t: [0] * (order - 1) + tokens(t)
    full, out = Counter(), Counter()
    context, context_out = Counter(), Counter()
    for i, t in docs:
        w = padded(t)
        for j in range(order - 1, len(w)):
            for k in range(1, order + 1):
                for total, ctx, on in ((full, context, part[i] > 0), (out, context_out, part[i] > 1)):
                    total[tuple(w[j - k + 1:j + 1])] += on
                    ctx[tuple(w[j - k + 1:j])] += on
    words = [g for g in full if len(g) == 1 and full[g]]
    n, v, n_out = sum(full[g] for g in words), len(words), sum(out[g] for g in out if len(g) == 1)

    def ratios(w, j, minus):
        c = lambda g: full[g] - minus * out[g]
        x = lambda g: context[g] - minus * context_out[g]
        found = [c((w[j],)) * ((v + 1) / max(n - minus * n_out, 1))]
        for k in range(2, order + 1):
            ctx = x(tuple(w[j - k + 1:j]))
            found.append(c(tuple(w[j - k + 1:j + 1])) * float(v + 1) / ctx if ctx else 0)
        last = x(tuple(w[j - order + 1:j])) if order > 1 else 1
        return found, min(last.bit_length(), L.MAX_BUCKET)

    cells = Counter()
    for i, t in docs:
        if part[i] == 2:
            w = padded(t)
            for j in range(order - 1, len(w)):
                found, b = ratios(w, j, 1)
                q = [0 if r <= 0 else min(max(round(L.STEPS * math.log2(r)) + L.CELLS // 2, 1), L.CELLS - 1) for r in found]
                cells[(b, *q)] += 1
    weights = L.learn([(*k, m) for k, m in cells.items()], order)
    rows = []
    for i, t in docs:
        w, s = padded(t), 0.0
        real = w[order - 1:]
        for j in range(order - 1, len(w)):
            found, b = ratios(w, j, 0)
            s += math.log10(sum(a * r for a, r in zip(weights[b], [1.0, *found], strict=True)) / (v + 1))
        base = sum(math.log10((full[(x,)] + 1) / (n + v + 1)) for x in real)
        rows.append((-1 if i is None else i, part[i] == 0, len(real), sum(full[(x,)] > 0 for x in real), n, base, s))
    return sorted(rows)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_plain_version(frame, order, monkeypatch):
    got = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in L.score(frame("doc_id long, text string", DOCS), order).collect())
    want = plain(DOCS, order)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-4, abs=1e-6)


def test_the_mixture_beats_the_base_on_held_out_documents(frame):
    rows = [r for r in L.score(frame("doc_id long, text string", DOCS)).collect() if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_estimates_sum_to_one(spark):
    weights = L.learn([(k, 256 + k, 260, 5) for k in range(5)], 2)
    assert weights.sum(1) == pytest.approx([1.0] * len(weights)) and weights[0, -1] == 0 and (weights[:, 0] > 0).all()


def test_small_batches_give_the_same(frame, monkeypatch):
    df = frame("doc_id long, text string", DOCS)
    want = sorted((r.doc_id or -1, r.n_known, round(r.score, 5)) for r in L.score(df).collect())
    got = sorted((r.doc_id or -1, r.n_known, round(r.score, 5)) for r in L.score(df.repartition(9, "text")).collect())
    assert got == want


def test_no_training_documents_and_empty_table(frame):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = L.score(frame("doc_id long, text string", [(i, "a b") for i in ids])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0.0, 0.0)] * 3
    assert L.score(frame("doc_id long, text string", DOCS).limit(0)).count() == 0
