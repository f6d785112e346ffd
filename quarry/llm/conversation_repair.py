"""Repair of conversation structure: the cheapest edits that give a conversation
turns of the form ``s?(ua)+`` (an optional system turn, then user and assistant
in turn) or none at all.

Edits go over the rows in order: Keep, Rerole (to user or assistant), Delete,
and Insert of an empty user or assistant turn. Of equally cheap edits those with
the least string of initials (the audit) are taken.

The search is a depth-first branch and bound with an explicit stack. A node is a
place between rows and what was put out last; its lower bound is the cost so far
and the cheapest way on under looser rules (a system turn may stand wherever a
user turn may); a prefix goes when the bound reaches the incumbent, the
cheapest and least audit found so far, or when the table of its node holds a
cheaper or lesser prefix. At the end nothing is left that could be better.

Rows are dealt by range, so that a conversation of any length is spread over
tasks, and cut into blocks. A block at whose edge a conversation goes on is
solved for every state in which it may begin and end; the blocks' tables are put
together conversation by conversation, and each block gets its part of the
audit. (Two prefixes of equal cost at one node are never one the beginning of
the other, as inserts cost; so the least audit is made of least parts.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import planned_parts, saved

#: Costs of the edits; an undeleted truncated row costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What was put out last: nothing, the system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
FINAL = (NOTHING, ASSISTANT)
#: The turn that may follow each state besides the system turn at the start.
_NEXT = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Rows of a block, as a power of two.
BLOCK_BITS = 8
WHITE = " \t\n\x0b\x0c\r"
_BEYOND = 1 << 60

#: A row of the search: the role's initial and the first fault (b, d, t or none).
Row = tuple[str, str]


def step(state: int, initial: str, edit: str) -> int | None:
    """The state after an edit of a row with that initial; None if it isn't allowed."""
    if edit == "D":
        return state
    wanted, after = _NEXT[state]
    if edit == "K":
        return SYSTEM if state == NOTHING and initial == "s" else after if initial == wanted else None
    return after


def _staying(fault: str) -> int | None:
    """What a row costs besides its edit if it stays; None if it can't."""
    return None if fault in ("b", "d") else TRUNCATED if fault == "t" else 0


def bounds(rows: list[Row], target: int) -> list[tuple[int, int]]:
    """Per place a lower bound of the cost from there to the end in ``target``,
    by whether an assistant turn is due: (no, yes). System turns may stand
    wherever a user turn may, and ends without output count as any other end."""
    due = target == USER
    at = (INSERT if due else 0, 0 if due else INSERT)
    found = [at]
    for initial, fault in reversed(rows):
        free, owed = at
        stays = _staying(fault)
        best = [free + DELETE, owed + DELETE]
        if stays is not None:
            best[0] = min(best[0], stays + (0 if initial == "u" else REROLE) + owed)
            if initial == "s":
                best[0] = min(best[0], stays + free)
            best[1] = min(best[1], stays + (0 if initial == "a" else REROLE) + free)
        at = (min(best[0], best[1] + INSERT), min(best[1], best[0] + INSERT))
        found.append(at)
    return found[::-1]


def search(rows: list[Row], entry: int, targets: tuple[int, ...]) -> tuple[int, str, int] | None:
    """(cost, audit, end) of the best edits from state ``entry`` to one of
    ``targets``, None if there are none."""
    n = len(rows)
    ahead = [(t, bounds(rows, t)) for t in targets]

    def bound(place: int, state: int) -> int:
        best = _BEYOND
        for target, table in ahead:
            if target in (NOTHING, SYSTEM):  # reached by deletions, and a system turn kept
                if state in (NOTHING, target) and n - place >= (state != target):
                    best = min(best, DELETE * (n - place - (state != target)))
            else:
                best = min(best, table[place][state == USER])
        return best

    incumbent: tuple[int, str, int] | None = None
    tables: dict[tuple[int, int], tuple[int, str]] = {}
    stack: list[tuple[int, int, int, str]] = [(0, entry, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        least = cost + bound(place, state)
        if least >= _BEYOND or incumbent and (least > incumbent[0] or least == incumbent[0] and audit >= incumbent[1]):
            continue
        known = tables.get((place, state))
        if known and known < (cost, audit):
            continue
        tables[place, state] = cost, audit
        if place == n and state in targets and (incumbent is None or (cost, audit) < incumbent[:2]):
            incumbent = cost, audit, state
        wayson = [(place, _NEXT[state][1], cost + INSERT, audit + "I")]
        if place < n:
            initial, fault = rows[place]
            stays = _staying(fault)
            wayson.append((place + 1, state, cost + DELETE, audit + "D"))
            if stays is not None:
                for edit, price in (("K", stays), ("R", stays + REROLE)):
                    if (after := step(state, initial, edit)) is not None:
                        wayson.append((place + 1, after, cost + price, audit + edit))
        better = [w for w in wayson if not ((known := tables.get(w[:2])) and known <= w[2:])]
        # The most promising is looked at first.
        for w in sorted(better, key=lambda w: (w[2] + bound(w[0], w[1]), w[3]), reverse=True):
            if not (known := tables.get(w[:2])) or w[2:] < known:
                tables[w[:2]] = w[2:]
                stack.append(w)
    return incumbent


def marked(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) in order, written once, with
    ``place`` (which grows along the order) and each row's ``initial``,
    ``blank``, ``truncated`` and ``said`` (a digest of role and text).

    Order: conv_id and turn (null first), then role, the first 32 characters, a
    digest of the text, and the order of reading. Repeated rows fall to tasks
    like others."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumns({"head": F.substring("text", 1, 32), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "head", "hash", "row"]
    ended = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return saved(rows.repartitionByRange(planned_parts(rows), *keys).sortWithinPartitions(*keys).select(
        "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place"), F.substring("role", 1, 1).alias("initial"),
        (ended == "").alias("blank"), (~ended.isin(".", "!", "?")).alias("truncated"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("said")), "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, place, block, initial, fault of ``marked`` rows: b (blank),
    d (role and text stood earlier in the conversation), t (truncated) or ''.
    The first of equal rows is found by an aggregate over digests, so a row
    that a conversation repeats without end is summed up in the tasks."""
    first = rows.groupBy("conv_id", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("truncated"), "t").otherwise("")
    return (rows.select("conv_id", "turn", "place", "initial", "blank", "truncated").join(first, "place", "left")
            .select("conv_id", "turn", "place", F.shiftright("place", BLOCK_BITS).alias("block"), "initial", fault.alias("fault")))


_WAY = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_PIECE = {"conv_id": None, "block": pa.int64(), "first_place": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
          "illegal": pa.int64(), "first_initial": pa.string(), "last_initial": pa.string(), "first_turn": pa.int64(),
          "last_turn": pa.int64(), "distinct": pa.int64(), "ways": pa.list_(_WAY)}
_PIECE_DDL = ("block long, first_place long, blank long, duplicate long, truncated long, illegal long, first_initial string, "
              "last_initial string, first_turn long, last_turn long, distinct long, ways array<struct<entry:int,leave:int,cost:long,audit:string>>")
LEGAL = ("su", "ua", "au")


def piece_of(rows: list[tuple], opens: bool, closes: bool) -> dict[str, Any]:
    """Counts and ways of a run of one conversation's rows (conv, turn, place,
    block, initial, fault). ``opens`` and ``closes``: the run may go on before
    or after the block; elsewhere it begins with nothing and must end well."""
    own = [(r[4], r[5]) for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    ways = []
    for entry in STATES if opens else (NOTHING,):
        for targets in [(t,) for t in STATES] if closes else [FINAL]:
            if found := search(own, entry, targets):
                ways.append({"entry": entry, "leave": found[2], "cost": found[0], "audit": found[1]})
    counts = {name: sum(f == name[0] for _, f in own) for name in ("blank", "duplicate", "truncated")}
    return counts | {"block": rows[0][3], "first_place": rows[0][2], "first_initial": own[0][0], "last_initial": own[-1][0],
                     "illegal": sum(a[0] + b[0] not in LEGAL for a, b in zip(own, own[1:], strict=False)),
                     "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                     "distinct": len(set(turns)), "ways": ways}


def pieces(faulty: DataFrame) -> DataFrame:
    """Per block and conversation the piece's counts and ways."""
    kind = faulty.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the rows of one block

        def close() -> pa.RecordBatch:
            runs: list[list[tuple]] = []
            for row in held:
                if runs and runs[-1][-1][0] == row[0]:
                    runs[-1].append(row)
                else:
                    runs.append([row])
            found = [piece_of(r, k == 0, k == len(runs) - 1) for k, r in enumerate(runs)]
            columns = [pa.array([r[0][0] for r in runs], ids)] + [pa.array([f[c] for f in found], t) for c, t in _PIECE.items() if t is not None]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=list(_PIECE))

        ids = pa.null()
        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "place", "block", "initial", "fault")), strict=True):
                if held and held[-1][3] != row[3]:
                    yield close()
                held.append(row)
        if held:
            yield close()

    ordered = (faulty.select("conv_id", F.col("turn").cast("long").alias("turn"), "place", "block", "initial", "fault")
               .repartition("block").sortWithinPartitions("block", "place"))
    return ordered.mapInArrow(run, f"conv_id {kind}, {_PIECE_DDL}")


class _Fold:
    """A conversation's pieces put together in order. Per state the best way
    there is kept; what all of them begin with is settled."""

    def __init__(self, conv: Any):
        self.conv, self.n = conv, 0
        self.best: dict[int, tuple[int, str, list[tuple]]] = {NOTHING: (0, "", [])}
        self.settled: list[tuple] = []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.distinct, self.last = 0, ""

    def add(self, piece: dict[str, Any]) -> None:
        for name in self.counts:
            self.counts[name] += piece[name]
        if self.n and self.last + piece["first_initial"] not in LEGAL:
            self.counts["illegal"] += 1
        self.n, self.last = self.n + 1, piece["last_initial"]
        if piece["first_turn"] is not None:
            self.distinct += piece["distinct"] - (self.high == piece["first_turn"])
            self.low, self.high = piece["first_turn"] if self.low is None else self.low, piece["last_turn"]
        found: dict[int, tuple[int, str, list[tuple]]] = {}
        for way in piece["ways"]:
            if before := self.best.get(way["entry"]):
                cost, audit = before[0] + way["cost"], before[1] + way["audit"]
                if (known := found.get(way["leave"])) is None or (cost, audit) < known[:2]:
                    found[way["leave"]] = cost, audit, [*before[2], (piece["block"], piece["first_place"], way["entry"], way["audit"])]
        ways = list(found.values())
        alike = 0
        while all(len(w[2]) > alike for w in ways) and len({w[2][alike] for w in ways}) == 1:
            alike += 1
        self.settled += ways[0][2][:alike]
        cut = sum(len(p[3]) for p in ways[0][2][:alike])
        self.best = {s: (cost, audit[cut:], parts[alike:]) for s, (cost, audit, parts) in found.items()}

    def result(self) -> dict[str, Any]:
        cost, _, rest = min((self.best[s] for s in FINAL if s in self.best), key=lambda b: b[:2])
        parts = [*self.settled, *rest]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv_id": self.conv, "gaps": gaps, **self.counts, "cost": cost, "audit": "".join(p[3] for p in parts), "parts": parts}


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _folded(found: DataFrame, with_parts: bool) -> DataFrame:
    """Pieces put together: the summary, or each block's part of the audit."""
    kind = found.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Fold | None = None
        done: list[dict] = []
        ids = pa.null()

        def batch_of() -> pa.RecordBatch:
            if with_parts:
                flat = [(r["conv_id"], *p) for r in done for p in r["parts"]]
                types = (ids, pa.int64(), pa.int64(), pa.int32(), pa.string())
                names = ["conv_id", "block", "first_place", "entry", "edits"]
                columns = list(zip(*flat, strict=True)) or [()] * 5
            else:
                types = (ids, *[pa.int64()] * 6, pa.string())
                names = ["conv_id", *_SUMMARY]
                columns = [[r[c] for r in done] for c in names]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for piece in (row for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist()):
                if now is None or now.conv != piece["conv_id"]:
                    if now is not None:
                        done.append(now.result())
                        if len(done) >= 2_000:
                            yield batch_of()
                    now = _Fold(piece["conv_id"])
                now.add(piece)
        if now is not None:
            done.append(now.result())
            yield batch_of()

    ddl = "block long, first_place long, entry int, edits string" if with_parts else ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in _SUMMARY)
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, f"conv_id {kind}, {ddl}")


def replayed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The edits of ``parts`` carried out on ``marked`` rows: (conv_id, place,
    seq, edit, role, text), in order of place and seq; deleted rows are there
    with their own role and text. Each block is replayed by itself."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    edits = parts.select("conv_id", F.col("first_place").alias("place"), "block", F.lit(0).alias("is_row"), "entry", "edits",
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    turns = rows.select("conv_id", "place", F.shiftright("place", BLOCK_BITS).alias("block"), F.lit(1).alias("is_row"),
                        F.lit(None).cast("int").alias("entry"), F.lit(None).cast("string").alias("edits"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        todo, at, state, conv, place, seq = "", 0, NOTHING, None, 0, 0

        def inserts() -> None:
            nonlocal at, state, seq
            while at < len(todo) and todo[at] == "I":
                state = _NEXT[state][1]
                out.append((conv, place, seq, "I", _ROLE[state], ""))
                at, seq = at + 1, seq + 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = (ids, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              names=["conv_id", "place", "seq", "edit", "role", "text"])
            out.clear()
            return made

        for batch in batches:
            ids = batch.schema.field("conv_id").type
            for c, p, is_row, entry, edits_, role, text in zip(*(batch.column(x).to_pylist() for x in (
                    "conv_id", "place", "is_row", "entry", "edits", "role", "text")), strict=True):
                if not is_row:
                    todo, at, state, conv = edits_, 0, entry, c
                    continue
                place, seq = p, 0
                inserts()
                edit, at = todo[at], at + 1
                after = step(state, role[:1], edit)
                out.append((conv, place, seq, edit, _ROLE[after] if edit == "R" else role, text))
                state, seq = after, seq + 1
                if "I" * (len(todo) - at) == todo[at:]:  # inserts behind the last row
                    inserts()
            yield batch_of()

    both = edits.unionByName(turns).repartition("block").sortWithinPartitions("block", "place", "is_row")
    return both.drop("block").mapInArrow(run, f"conv_id {kind}, place long, seq long, edit string, role string, text string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, edited) of ``turns`` (conv_id, turn, role, text).

    summary, per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. edited: conv_id, place, seq, edit, role, text, the
    turns after the edits (and the deleted ones, edit D) in order of place and
    seq.

    A null role or text is one space. Rows with a null conv_id are one
    conversation; null turns come first and count in no gap. Rows of one turn
    stand by role and text; repeated rows are duplicates. An empty table gives
    no rows. Other columns are not read. Texts of any length are read whole; of
    a long conversation a task holds a block of rows, and in the end its audit,
    a letter for each row."""
    rows = marked(turns)
    found = saved(pieces(faults(rows)), "repair-pieces")
    return _folded(found, False), replayed(rows, saved(_folded(found, True), "repair-edits"))


def text_digests(edited: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of ``role:text`` of all turns that are left,
    joined by line feeds. A digest runs over its text in order, so the turns of
    a conversation pass through one task, one at a time."""
    kind = edited.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ids = None, None, pa.null()
        for batch in batches:
            ids = batch.schema.field("conv_id").type
            done: list[tuple] = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if held is None or conv != current:
                    if held is not None:
                        done.append((current, held.hexdigest()))
                    current, held = conv, hashlib.sha256()
                else:
                    held.update(b"\n")
                held.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], ids), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], ids), pa.array([held.hexdigest()])], names=["conv_id", "repaired_sha256"])

    ordered = edited.filter(F.col("edit") != "D").repartition("conv_id").sortWithinPartitions("conv_id", "place", "seq")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults dealt by crc32 of ``conv_id:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes
    it a user's. Nulls are one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = (F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text")))
    return (turns.select("conv_id", "turn", "role", "text", dealt.alias("dealt")).filter(F.col("dealt") != 0)
            .select("conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def audit_conversations(turns: DataFrame) -> DataFrame:
    """Damage, repair and digest: per conversation of ``turns`` its summary and
    repaired_sha256; one that lost all rows has zeros, an empty audit and the
    digest of nothing."""
    summary, edited = repair(damaged(turns))
    every = turns.select(F.col("conv_id").alias("__conv")).distinct()
    hashes = text_digests(edited).withColumnRenamed("conv_id", "__hashed")
    joined = (every.join(summary, F.col("__conv").eqNullSafe(F.col("conv_id")), "left")
              .join(hashes, F.col("__conv").eqNullSafe(F.col("__hashed")), "left"))
    return joined.select(F.col("__conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _SUMMARY[:-1]],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
