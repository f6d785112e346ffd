"""Conversation repair against an exhaustive search and a plain replay."""

import hashlib
import heapq
import random
import time
import zlib

import pytest

from quarry.llm import conversation_repair as R


def best_plainly(rows, entry=R.NOTHING, targets=R.FINAL):
    """Cheapest, least edits: nodes (row, state) settled in order of (cost, audit)."""
    best, todo = {}, [(0, "", 0, entry)]
    while todo:
        cost, audit, i, state = heapq.heappop(todo)
        if (i, state) in best:
            continue
        best[i, state] = cost, audit
        last = {0: "", 1: "s", 2: "u", 3: "a"}[state]
        due = "a" if last == "u" else "u"
        after = {"u": 2, "a": 3}
        ways = [((i, after[due]), cost + 3, audit + "I")]
        if i < len(rows):
            initial, fault = rows[i]
            ways.append(((i + 1, state), cost + 4, audit + "D"))
            if fault not in ("b", "d"):
                more = 3 * (fault == "t")
                if initial == due:
                    ways.append(((i + 1, after[due]), cost + more, audit + "K"))
                elif initial == "s" and state == 0:
                    ways.append(((i + 1, 1), cost + more, audit + "K"))
                ways.append(((i + 1, after[due]), cost + 3 + more, audit + "R"))
        for node, c, a in ways:
            heapq.heappush(todo, (c, a, *node))
    found = [(*best[len(rows), t], t) for t in targets if (len(rows), t) in best]
    return min(found) if found else None


def random_rows(rng, n):
    return [(rng.choice("uuaaasx"), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(n)]


def test_search_is_optimal_for_every_entry_and_end():
    rng = random.Random(5)
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(0, 12))
        for entry in R.STATES:
            for targets in [R.FINAL, *((t,) for t in R.STATES)]:
                assert R.search(rows, entry, targets) == best_plainly(rows, entry, targets), (rows, entry, targets)


@pytest.mark.parametrize("rows", [[("s", "")] * 256, [("a", "t")] * 256, [("u", ""), ("a", ""), ("s", "t")] * 85, [("x", "d"), ("u", "")] * 128],
                         ids=["system", "truncated", "mixed", "half"])
def test_long_blocks_end_soon(rows):
    began = time.time()
    found = R.search(rows, R.NOTHING, (R.ASSISTANT,))
    assert time.time() - began < 20
    assert found == best_plainly(rows, R.NOTHING, (R.ASSISTANT,))


def plainly(turns):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)} of undamaged rows."""
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2], t[3]) for t in turns if t[0] == conv))
        seen, faults, rows = set(), [], []
        for _, _, role, text in own:
            body = text.strip(R.WHITE)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            rows.append((role[:1], fault))
        turnsof = [t for some, t, _, _ in own if some]
        cost, audit, _ = best_plainly(rows)
        repaired, state, i = [], 0, 0
        for edit in audit:
            due = "assistant" if state == 2 else "user"
            if edit == "I":
                repaired.append(f"{due}:")
            else:
                role, text = own[i][2:]
                i += 1
                if edit == "D":
                    continue
                repaired.append(f"{due if edit == 'R' else role}:{text}")
            state = 1 if repaired[-1].startswith("s") else 3 if due == "assistant" else 2
        out[conv] = (max(turnsof) - min(turnsof) + 1 - len(set(turnsof)) if turnsof else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def damaged_plainly(turns):
    out = []
    show = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in turns:
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = "user" if k == 4 else show(role), "" if k == 1 else show(text)
        if k == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def some_turns(seed, conversations, longest):
    rng = random.Random(seed)
    turns = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            if rng.random() < 0.9:
                turns.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "user", "assistant", ""]),
                              rng.choice([f"Said {turn}.", "Same.", "cut off", " \n", "Why?\t", f"Well {rng.randrange(9)}!"])))
    return turns


def check(spark, frame, turns):
    found = R.audit_conversations(frame("conv_id long, turn long, role string, text string", turns))
    found = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    want = plainly(damaged_plainly(turns))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert found == {c: want.get(c, nothing) for c in {t[0] for t in turns}}


def test_conversations_are_repaired_as_plainly(spark, frame):
    turns = some_turns(1, 120, 14) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 5, "assistant", "Yes."), (None, 5, "assistant", None),
                                      (900, None, "assistant", "First."), (900, None, "user", "Second."), (900, 3, "user", "x" * 100_000)]
    check(spark, frame, turns)


def test_a_conversation_over_many_blocks(spark, frame, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BITS", 3)
    rng = random.Random(3)
    turns = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", f"No {t}", f"Said {t}.", ""])) for t in range(900)]
    check(spark, frame, turns + some_turns(2, 40, 9))


def test_empty_table(spark, frame):
    assert R.audit_conversations(frame("conv_id long, turn long, role string, text string", [])).count() == 0
