"""Token files: exact round trips, random access, ids of whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import token_store
from quarry.llm.common import scratch
from quarry.llm.token_store import Encoder, Segment, chunk_widths, encode_segment

TOKENIZER = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_segments_round_trip_and_give_any_token(ids, data):
    ids = np.array(ids, np.uint32)
    held = Segment(encode_segment(1, 2, 3, [("a", len(ids))], ids) + b"\n")
    assert (held.part, held.seq, held.before, held.n_tokens, held.docs()) == (1, 2, 3, len(ids), [["a", len(ids)]])
    assert held.tokens().tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert held.tokens(a, b).tolist() == ids[a:b].tolist()
    assert [held.token(i) for i in range(len(ids))] == ids.tolist()


def test_widths_are_the_best_of_all():
    from itertools import combinations

    ids = np.array([1, 2, 3, 200, 300, 5, 40_000, 7, 9, 0], np.uint32)
    longest = 16

    def bits(widths):
        total, rest = 0, ids
        for k, w in enumerate(widths):
            total += len(rest) * (w + (k + 1 < len(widths)))
            rest = rest >> np.uint32(w)
            rest = rest[rest > 0]
        return total
    every = [np.diff([0, *cut, longest]).tolist() for n in range(longest) for cut in combinations(range(1, longest), n)]
    assert bits(chunk_widths(ids)) == min(map(bits, every))


def test_damage_is_an_error():
    data = bytearray(encode_segment(0, 0, 0, [(1, 3)], np.array([1, 500, 70], np.uint32)))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        Segment(bytes(data))


ODD = ["", " ", "It's  A\tTest.\r\nÉTÉ ＡＢ é ́x  y z\x0bq\x1cr", "<|endoftext|> a<|startoftext|>b", "İstanbul ΟΔΟΣ ΣΑΣ.", "''s 'll can't x" * 40,
       "日本語 テスト 123 4.5", "á ́ a ́", "가 ᆨ", "x" * 5000, "H\u0331a. K\u0327! e\u0301. A.\u0301 b.,c. D.\u00a0e. F.\x1c g.\u0327", "Wort. Été.. ÉTÉ! L'AN. (a.) b.) It'S.", "😀 😀👍 end\n\n"]


def test_pieces_have_the_ids_of_the_whole_text():
    import pyarrow as pa

    plain = Tokenizer.from_str(TOKENIZER)
    ids, sizes = Encoder(TOKENIZER, 2)(pa.array([*ODD, None]))
    want = [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in [*ODD, ""]]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    again, _ = Encoder(TOKENIZER, 2, whole=True)(pa.array([*ODD, None]))
    assert again.tolist() == ids.tolist()


@settings(max_examples=80, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x0c'sSİΣ゙̧́‍ ")), max_size=60))
def test_any_text_has_the_ids_of_the_whole(text):
    _same(text)


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("abcXYZ ªµºÀÉÖØßäöüÿñçIİı.,'\n"), max_size=80))
def test_latin_text_has_the_ids_of_the_whole(text):
    _same(text)


def _same(text):
    import pyarrow as pa

    ids, _ = _encoder(pa.array([text]))
    assert ids.tolist() == [*_encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


_encoder = Encoder(TOKENIZER, 2)


@pytest.mark.parametrize("segment", [7, 1 << 22])
def test_store_reads_back_every_document(spark, frame, segment):
    docs = [(5, ODD[2]), (None, "no id"), (2, None), (2, "again two"), (9, "long " * 3000), (-4, "first"), (None, ODD[6]), (7, "")]
    path = scratch(spark, "tokens-test")
    token_store.write_tokens(frame("doc_id long, text string", docs).coalesce(1), path, TOKENIZER, 2, segment_tokens=segment)
    plain, want, start = Tokenizer.from_str(TOKENIZER), [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    found = [tuple(r) for r in token_store.read_documents(spark, path, with_ids=True).orderBy("start").collect()]
    assert found == want
    every = [t for row in want for t in row[4]]
    at = spark.createDataFrame([(p,) for p in [0, 3, 3, 17, len(every) - 1, len(every), -1, None]], "position long")
    assert sorted(map(tuple, token_store.tokens_at(spark, path, at).collect())) == sorted((p, every[p]) for p in [0, 3, 3, 17, len(every) - 1])


def test_empty_table_and_text_ids(spark, frame):
    path = scratch(spark, "tokens-test")
    token_store.write_tokens(frame("doc_id long, text string", []), path, TOKENIZER, 2)
    assert token_store.read_documents(spark, path).count() == 0
    path = scratch(spark, "tokens-test")
    token_store.write_tokens(frame("doc_id string, text string", [("b\n", "x"), ('a"', None)]), path, TOKENIZER)
    assert [r.doc_id for r in token_store.read_documents(spark, path, "string").orderBy("start", "n_tokens").collect()] == ['a"', "b\n"]


def test_tasks_of_a_worker_share_what_is_known(monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_PIECES", 6)
    texts = [["one two. three", None], ["two. one Four", ""], ["five six seven eight", "one two."], ["", None]]
    encode = token_store._encoder(TOKENIZER, 2, False)
    assert token_store._encoder(TOKENIZER, 2, False) is encode
    for some in texts:
        ids, sizes = encode(token_store.pa.array(some, "string"))
        own, alone = Encoder(TOKENIZER, 2)(token_store.pa.array(some, "string"))
        assert ids.tolist() == own.tolist() and sizes.tolist() == alone.tolist()
