import random

import pytest
from plain import targets, words

from quarry.llm import mixing as M


def test_targets_copies_and_totals(frame):
    r = random.Random(2)
    docs = [(i, " ".join(["w"] * r.choice([0, 1, 5, 20, 20, 20, 300])), r.choice(["a", "a", "a", "b", "ö", None])) for i in range(900)]
    docs += [(901, None, "nothing"), (902, "", "nothing"), (903, "one big " * 200, "lone")]
    df = frame("doc_id long, text string, source string", docs, clashing=("ordinal", "first", "target", "place", "limit"))
    got = M.mix(df).collect()
    assert len(got) == len(docs)
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source], abs=1e-6)
        assert 0 <= x.taken <= 2 * x.size and x.taken == x.copies * x.size
        taken[x.source] += x.taken
    for source, n in taken.items():
        assert abs(n - want[source]) <= 600
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = M.mix(df.repartition(7)).collect()
    key = lambda x: (x.doc_id, x.taken, x.target)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_hot_source_repeated_rows_and_empty_table(frame):
    docs = [(i, "w w w", "hot") for i in range(3000)] + [(5, "w w", "cold")] * 3 + [(None, "w", None)]
    df = frame("doc_id long, text string, source string", docs)
    rows = M.mix(df).collect()
    hot = [x for x in rows if x.source == "hot"]
    assert abs(sum(x.taken for x in hot) - hot[0].target) <= 6
    assert len(rows) == len(docs)
    assert M.mix(df.limit(0)).count() == 0
    nothing = M.mix(frame("doc_id long, text string, source string", [(1, None, "a"), (2, "", None)])).collect()
    assert [(x.size, x.target, x.taken) for x in nothing] == [(0, 0.0, 0)] * 2
