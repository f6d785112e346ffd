"""The pipeline against a plain version, stage after stage."""

import zlib

import numpy as np
import plain
import pytest

import corpus_pipeline as P
from quarry.llm import language_id as G
from quarry.llm import mixing
from quarry.llm import quality_rules as Q
from quarry.llm.common import saved

SF = "/root/testdata/sf0.001"


def languages(docs):
    vectors = {}
    for i, text, lang, *_ in docs:
        counts, grams, alphabet = G.trigrams([text])
        vectors[i] = G.bundle(counts, grams, alphabet, G.DIMENSIONS)[0] / max(1.0, counts.sum())
    sums = {}
    for i, _, lang, *_ in docs:
        if lang is not None and zlib.crc32(str(i).encode()) % 5:
            sums[lang] = sums.get(lang, 0) + vectors[i].astype(float)
    best = {}
    for i, v in vectors.items():
        best[i] = max((float(v @ s) / (np.linalg.norm(v) * np.linalg.norm(s) or 1) for s in sums.values()), default=0)
    return best


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in P.STAGES:
        found.append(saved(stage(spark, found[-1], SF), "pipeline-test"))
    return [sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[-1])) for df in found]


def test_each_stage_on_its_own_input(stages, spark):
    docs, clean, spoken, single, fresh, mix = stages
    want = [(i, m[9], lang, source, len(m[9])) for i, t, lang, source, _ in docs if (m := Q.judge(t, Q.Rules()))[6]]
    assert clean == want and 0 < len(clean) < len(docs)
    score = languages(clean)
    assert spoken == [r for r in clean if score[r[0]] >= P.MIN_SCORE]
    groups = {i: c for i, _, c in plain.near_duplicates([r[:2] for r in spoken])}
    assert single == [r for r in spoken if groups[r[0]] == r[0]] and len(single) < len(spoken)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _, h, _ in plain.contamination([r[:2] for r in single], items) if h}
    assert hit and fresh == [r for r in single if r[0] not in hit]
    sizes, taken = {}, {}
    for r in fresh:
        sizes[r[3]] = sizes.get(r[3], 0) + len(plain.words(r[1]))
    for r in mix:
        taken[r[3]] = taken.get(r[3], 0) + len(plain.words(r[1]))
    targets = plain.targets(sizes)
    longest = max(len(plain.words(r[1])) for r in fresh)
    assert all(abs(taken.get(s, 0) - t) <= 2 * longest for s, t in targets.items())
    assert {r[:5] for r in mix} <= set(fresh) and {r[5] for r in mix} <= {1, 2}


def test_odd_documents_pass_every_stage(spark, frame):
    text = " ".join(f"Word number {i} of this little story comes here." for i in range(20))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (2, None, "en", None, 0), (3, "", None, "b", 0), (4, "12 " * 60, "en", "a", 1)]
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", rows, clashing=("id", "copy", "copies", "n", "kept", "component_id"))
    for name, stage in P.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF)
            assert out.columns[:5] == list(P.COLUMNS)
            n = out.count()
            assert n == 0 if df is not docs else n >= 0
    assert {r.doc_id for r in P.near_duplicates(spark, docs, SF).collect()} == {1, 2, 3, 4}
    assert P.near_duplicates(spark, docs, SF).count() == 4


def test_rows_of_one_id_or_without_id_are_judged_apart(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    story = lambda name: " ".join(f"Word number {i} of the {name} story comes here." for i in range(20))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    texts = lambda rows: [(i, t, "en", s, len(t)) for i, t, s in rows]
    for written in (False, True):
        make = lambda rows: saved(frame(schema, texts(rows)), "pipeline-test") if written else frame(schema, texts(rows))  # noqa: B023, E731
        docs = make([(None, story("old"), "a"), (None, story("new"), "a"), (None, f"{story('red')} {item}", "a"), (7, story("blue"), "a"), (7, item, "b")])
        assert sorted(r.text for r in P.decontaminated(spark, docs, SF).collect()) == sorted(map(story, ("old", "new", "blue")))
        docs = make([(None, story("old"), "a"), (None, story("old") + " End.", "a"), (None, story("new"), "b"), (5, story("blue"), "a"),
                     (5, story("blue") + " End.", "a"), (5, story("red"), "a"), (4, story("red") + " End.", "a"), (9, "", "a"), (9, "", "a"), (None, "", "a"), (None, "", "b")])
        got = [(r.doc_id, r.text.removesuffix(" End.")) for r in P.near_duplicates(spark, docs, SF).collect()]
        assert sorted(got, key=str) == sorted([(None, story("old")), (None, story("new")), (5, story("blue")), (4, story("red")), (9, ""), (None, ""), (None, "")], key=str)
        docs = make([(None, " ".join(["word"] * n), s) for n in range(1, 15) for s in "abc"] + [(1, "one more text", "a")] * 5)
        taken, want = {}, {r.source: r.words for r in mixing.mix(docs).groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "words").collect()}
        for r in P.mixed(spark, docs, SF).collect():
            taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        assert taken == want
