import hashlib
import random

from quarry.llm import chat_format as C


def test_escapes_are_reversible_and_hide_control_strings():
    r = random.Random(3)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "[", "/", "a", "\n", " ", "é", "<\\s>"]
    for _ in range(2000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        hidden = C.escape(text)
        assert C.unescape(hidden) == text
        assert not any(c in hidden for c in C.CONTROL)
        turns = [("user", text), (text, "x"), ("assistant", text)]
        assert C.read_back(C.instruct_template(turns)) == turns


def test_locate_finds_spans_and_texts_in_long_conversations_too():
    r = random.Random(5)
    for n in (0, 1, 2, 15, 16, 17, 18, 40):
        turns = [(r.choice(["user", "assistant", "system"]), "".join(r.choice("ab</s>[INST] ") for _ in range(r.randint(0, 20)))) for _ in range(n)]
        found = C.locate(C.instruct_template, turns)
        assert found.formatted == C.instruct_template(turns) and not found.rewrites
        whole = C.locate(C.instruct_template, turns, context=100)
        assert (found.spans, found.texts) == (whole.spans, whole.texts)
        assert "".join(found.formatted[a:b] for a, b in found.spans) == found.formatted
        assert [C.unescape(found.formatted[a:b]) for a, b in found.texts] == [t for _, t in turns]


def test_templates_that_rewrite_history_are_detected():
    def drops_earlier_thoughts(turns):
        return "".join(f"<{role}>{text if k == len(turns) - 1 else text.split('|')[-1]}" for k, (role, text) in enumerate(turns))

    def counts_turns(turns):
        return f"{len(turns)} turns:" + "".join(f"<{role}>{text}" for role, text in turns)

    turns = [("user", "q"), ("assistant", "thought|answer"), ("user", "q2"), ("assistant", "more|end")]
    assert C.locate(drops_earlier_thoughts, turns).rewrites == [2]
    assert C.locate(counts_turns, turns).rewrites == [0, 1, 2, 3]
    assert C.locate(counts_turns, turns * 20).rewrites
    assert C.locate(drops_earlier_thoughts, turns).texts == [None] * 4


def test_templates_that_look_at_the_whole_prefix_in_long_conversations():
    def numbered(turns):
        return "".join(f"<{k}:{role}>{text}" for k, (role, text) in enumerate(turns))

    def alternating(turns):
        assert all(role == ("user", "assistant")[k % 2] for k, (role, _) in enumerate(turns))
        return "".join(f"<{role}>{text}" for role, text in turns)

    def breaks_off_once(turns):
        return "".join(f"<{role}>{text if k or len(turns) != 18 else '?'}" for k, (role, text) in enumerate(turns))

    for n in (17, 18, 40):
        turns = [(("user", "assistant")[k % 2], f"text {k}") for k in range(n)]
        for template in (numbered, alternating):
            found = C.locate(template, turns)
            assert found.formatted == template(turns) and not found.rewrites
            assert [found.formatted[a:b] for a, b in found.texts] == [t for _, t in turns]
            assert "".join(found.formatted[a:b] for a, b in found.spans) == found.formatted
        assert C.locate(numbered, turns, context=16) == C.locate(numbered, turns)
        assert C.locate(breaks_off_once, turns).rewrites == ([] if n < 18 else [17] if n == 18 else [17, 18])


def test_digests_of_nulls_ties_and_repeated_rows(frame):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "</s>"), (1, 2, "assistant", "</s>[INST] ok [/INST]"),
            (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, 0, "user", "x" * 200_000), (3, None, "user", ""), (3, 5, "assistant", "")]
    df = frame("conv_id long, turn long, role string, text string", rows)
    got = {r.conv_id: r for r in C.digests(C.format_conversations(df)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha("user\n\nassistant\nb\n\n</s>\nassistant\n</s>[INST] ok [/INST]\n")
    assert got[1].loss_sha256 == sha("b</s>[INST] ok [/INST]") and got[1].loss_chars == 1 + len("</s>[INST] ok [/INST]")
    assert got[2].n_turns == 2 and got[2].loss_sha256 == sha("samesame")
    assert got[None].n_turns == 1 and got[None].loss_chars == 0 and got[None].formatted_chars > 200_000
    assert got[3].turns_sha256 == sha("user\n\nassistant\n\n")
    assert C.digests(C.format_conversations(df.limit(0))).count() == 0
