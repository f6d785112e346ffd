import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import language_id as G

SYLLABLES = {"aa": "ka to mi su re no".split(), "bb": "sch er ung lich au pf".split(), "cc": "ção em os ã lh qu".split()}


def text(r, lang, n=40):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    return [(i, text(r, lang), lang) for i, lang in enumerate(r.choice(list(SYLLABLES)) for _ in range(300))]


def test_held_out_accuracy_and_plain_values(frame, rows):
    df = frame("doc_id long, text string, lang string", rows, clashing=("lang_pred", "v", "__x"))
    out = G.held_out(F.col("doc_id"))
    model = G.learn(df.filter(~out), 512)
    got = {r.doc_id: r for r in G.predict(df, model).collect()}
    lang = {i: x for i, _, x in rows}
    assert model.languages == ("aa", "bb", "cc")
    assert sum(r.lang_pred == lang[i] for i, r in got.items()) > 0.98 * len(rows)

    def vector(t):  # one trigram after the other
        t = "".join(c.lower() if c.isalpha() else " " for c in f" {t} ")
        t = " ".join(t.split()).join("  ")
        v = np.zeros(512)
        for a, b, c in zip(t, t[1:], t[2:], strict=False):
            letter = lambda x: G._letter_vector(0 if x == " " else ord(x), 512)
            v += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
        return v
    for i, t, _ in rows[:20]:
        v = vector(t)
        cosine = model.vectors @ v / np.linalg.norm(v)
        assert got[i].score == pytest.approx(max(0, min(1, cosine.max())), abs=1e-4)


def test_odd_texts_ties_and_empty_tables(frame, rows):
    df = frame("doc_id long, text string, lang string", [*rows, (900, None, "aa"), (901, "12 !", "bb"), (902, "x" * 300_000, None), (None, "ka", "aa"), (903, "漢字 Ω", "cc")])
    model = G.learn(df, 256)
    odd = df.filter("doc_id >= 900 or doc_id is null")
    got = {r.doc_id: (r.lang_pred, r.score) for r in G.predict(odd, model).collect()}
    assert got[900] == got[901] == (G.UNKNOWN, 0.0) and got[None][0] == "aa" and 0 <= got[902][1] <= 1 and got[903][0] == "cc"
    same = G.Prototypes(("p", "q"), np.stack([model.vectors[0]] * 2))
    assert {r.lang_pred for r in G.predict(df.limit(5), same).collect()} <= {"p"}
    nothing = G.learn(df.limit(0), 256)
    assert nothing.languages == () and {r.lang_pred for r in G.predict(odd, nothing).collect()} == {G.UNKNOWN}
    assert G.predict(df.limit(0), model).count() == 0
