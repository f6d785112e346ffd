from plain import base_measures

from quarry.llm import quality_rules as Q

SENTENCE = "The old house by the river was sold to a young family last week."
CLEAN = "\n".join(f"On day{i} the team{i} met near gate{i}, and then road{i} led them{i} home{i} again{i}." for i in range(12))


def results(frame, texts):
    docs = frame("doc_id long, text string", list(enumerate(texts)))
    return sorted(Q.line_first_rules(docs).collect(), key=lambda r: r.doc_id)


def test_base_measures_match_plain_counts(frame):
    texts = [None, "", " \n\t ", "one", "a b c a b c", "a b c d a b c", "x\nx\ny\nx \n\n\n", "#*$%&|<>", "é\u00a0ü \u2003 z",
             "w " * 5000, CLEAN, "a b a b a b a b", "\n".join(["same line here"] * 40), "\x0b\x0c\x1c a\x1fb"]
    for text, row in zip(texts, results(frame, texts), strict=True):
        n, chars, symbols, lines, repeated = base_measures(text) if len(text or "") < 5000 else (5000, 5000, 0, 0, 5000)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (row.kept and row.base_failed)


def test_lines_fail_by_rule_and_documents_by_loss(frame):
    menu = "Home | News | Sport | Weather | Travel | More"
    cookie = "This site uses cookies. Read our Cookie Policy."
    shout = "BUY!! NOW!! CHEAP!! PILLS!!"
    assert Q.failed_rule(menu, menu.split(), Q.Rules()) == "navigation"
    assert Q.failed_rule(cookie, cookie.split(), Q.Rules()) == "boilerplate"
    assert Q.failed_rule(shout, shout.split(), Q.Rules()) == "punctuation"
    assert Q.failed_rule("a heading", ["a", "heading"], Q.Rules()) == "punctuation"
    assert Q.failed_rule(SENTENCE, SENTENCE.split(), Q.Rules()) is None
    assert Q.failed_rule('He said "yes."', 'He said "yes."'.split(), Q.Rules()) is None
    light, heavy = f"{menu}\n{CLEAN}\n{cookie}", CLEAN + "".join(f"\nBUY{i}!! NOW{i}!! CHEAP{i}!!" for i in range(40))
    a, b, c = results(frame, [light, heavy, CLEAN])
    assert a.kept and a.clean_text == CLEAN and a.n_removed_lines == 2
    assert not b.kept
    assert c.kept and c.clean_text == CLEAN and c.n_removed_words == 0


def test_repeated_rows_and_empty_table(frame, spark):
    docs = frame("doc_id long, text string", [(1, CLEAN), (1, CLEAN), (None, CLEAN)])
    assert [r.kept for r in Q.line_first_rules(docs).collect()] == [True] * 3
    assert Q.line_first_rules(docs.limit(0)).count() == 0
