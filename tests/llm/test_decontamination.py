import hashlib
import random

from plain import contamination

from quarry.llm import decontamination as D


def check(frame, docs, items):
    got = D.decontaminate(frame("doc_id long, text string", docs), frame("item_id long, text string", items))
    rows = sorted((r.doc_id or -1, r.n_words, r.n_hit, r.item_ids) for r in got.collect())
    want = sorted((d or -1, n, h, i) for d, n, h, i in contamination(docs, items))
    assert rows == want
    for r in got.collect():
        assert r.contaminated == (r.n_hit > 0) and r.n_items == len(r.item_ids)
        assert r.items_sha256 == hashlib.sha256(",".join(r.item_ids).encode()).hexdigest()
    return rows


def test_against_plain_version(frame):
    r = random.Random(1)
    vocabulary = ["a", "b", "the", "Fox", "école", "ÉCOLE", "x1", "İz", "zz"]
    passage = " ".join(r.choice(vocabulary) for _ in range(14))
    items = [(1, passage), (2, passage.upper()), (30, "one two three"), (4, "zz"), (5, "b  the"), (6, None), (7, " ,. "), (8, passage[:40])]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 40))) + r.choice(["", f", {passage}!", f" {passage} {passage}", " ONE-two three"]))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "zz"), (103, "one two"), (104, passage), (104, passage), (None, passage)]
    rows = check(frame, docs, items)
    assert any(h for _, _, h, _ in rows)


def test_long_items_only_and_empty_sides(frame):
    item = "q w e r t y u i o p a s d f g"
    docs = [(1, "xx " + item + " yy"), (2, "q w e r t y u i o"), (3, "w e r t y u i o p a"), (4, "é" * 10)]
    check(frame, docs, [(9, item)])
    assert check(frame, docs, [(9, None)])
    empty = frame("doc_id long, text string", docs).limit(0)
    assert D.decontaminate(empty, frame("item_id long, text string", [(1, item)])).count() == 0
