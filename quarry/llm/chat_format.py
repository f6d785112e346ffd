"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string.
The formatter knows nothing about it: it renders successive turn prefixes and
compares consecutive outputs. What the longer output adds is the turn's span;
rendering the turn once more with a one-sign probe as its text shows where
the text itself lies in the span. An output that does not begin with the one
before it means that the template rewrites history, which is reported.

Conversations are streamed from partitions sorted by conversation and turn: a
task holds one conversation at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

PROBE = "\ue000"
#: Turns up to which every prefix is rendered whole; None: in conversations of any length.
CONTEXT = None
#: The template's control strings.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_control = re.compile("|".join(map(re.escape, CONTROL)))
_escaped = re.compile(r"\\(.)", re.DOTALL)
_turn = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    """Reversibly break control strings: a backslash is doubled, and one goes
    behind the first sign of a control string."""
    return _control.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def instruct_template(turns: list[Turn]) -> str:
    """A turn is ``<s>[INST] role [/INST] text</s>``, role and text escaped."""
    return "".join(f"<s>[INST] {escape(role)} [/INST] {escape(text)}</s>" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an ``instruct_template`` output."""
    return [(unescape(m[1]), unescape(m[2])) for m in _turn.finditer(formatted)]


@dataclass(frozen=True)
class Located:
    """The rendered conversation; per turn the start and end of its span, of
    its text, or of None where the template does not show the text as it is;
    the turns after which earlier output had changed."""

    formatted: str
    spans: list[tuple[int, int]]
    texts: list[tuple[int, int] | None]
    rewrites: list[int]


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _step(template: Template, before: list[Turn], earlier: str, turn: Turn) -> tuple[str, str | None, tuple[int, int] | None]:
    """(output with the turn, what it adds or None if it rewrites, header and trailer length)."""
    after = template([*before, turn])
    if not after.startswith(earlier):
        return after, None, None
    probe = template([*before, (turn[0], PROBE)])
    edge = probe.find(PROBE, len(earlier)) if probe.startswith(earlier) else -1
    if edge < 0 or len(after) - len(earlier) < len(probe) - len(earlier) - 1:
        return after, after[len(earlier):], None
    return after, after[len(earlier):], (edge - len(earlier), len(probe) - edge - 1)


def locate(template: Template, turns: list[Turn], context: int | None = CONTEXT) -> Located:
    """Render ``turns`` and locate each of them, every prefix rendered whole.

    Only where ``context`` is given, turns beyond so many are rendered behind
    the first and the last ``context - 1`` turns, and the pieces put together
    must equal one rendering of the whole; if they don't, all prefixes are
    rendered whole after all. A template that rewrites a prefix and restores
    it later, or that checks the order of turns, needs whole prefixes."""
    if context is not None and len(turns) > context + 1 and (found := _behind_context(template, turns, context)):
        return found
    earlier = template([])
    spans: list[tuple[int, int]] = []
    texts: list[tuple[int, int] | None] = []
    rewrites: list[int] = []
    for k, turn in enumerate(turns):
        after, piece, edge = _step(template, turns[:k], earlier, turn)
        if piece is None:  # rewritten history: the span is what follows the common part
            rewrites.append(k)
        start = len(earlier) if piece is not None else _common(earlier, after)
        spans.append((start, len(after)))
        texts.append(edge and (start + edge[0], len(after) - edge[1]))
        earlier = after
    # Where history is rewritten, no place in an earlier output holds in the last one.
    return Located(earlier, spans, [None] * len(turns) if rewrites else texts, rewrites)


def _behind_context(template: Template, turns: list[Turn], context: int) -> Located | None:
    """All turns, rendered behind the first and the last ``context - 1`` ones;
    None if a turn rewrites or the pieces are not the whole."""
    earlier = template([])
    start, pieces = len(earlier), [earlier]
    spans, texts = [], []
    for k, turn in enumerate(turns):
        before = turns[:k]
        if k > context:
            before = [turns[0], *turns[k - context + 1:k]]
            earlier = template(before)
        earlier, piece, edge = _step(template, before, earlier, turn)
        if piece is None:
            return None
        pieces.append(piece)
        spans.append((start, start + len(piece)))
        texts.append(edge and (start + edge[0], start + len(piece) - edge[1]))
        start += len(piece)
    formatted = template(turns)
    return Located(formatted, spans, texts, []) if "".join(pieces) == formatted else None


SCHEMA = ("conv_id long, formatted string, spans array<struct<start:long,end:long>>, "
          "loss array<struct<start:long,end:long>>, rewrites array<long>")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Conversations of a partition sorted by conversation; one is held at a time."""
    current: int | None = None
    turns: list[Turn] = []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and conv != current:
                yield current, turns
                turns = []
            current = conv
            turns.append((role or "", text or ""))
    if turns:
        yield current, turns


def format_conversations(turns: DataFrame, template: Template = instruct_template,
                         loss_roles: tuple[str, ...] = ("assistant",), context: int | None = CONTEXT) -> DataFrame:
    """Per conversation: conv_id, formatted text, span of each turn, spans
    under the loss mask (the texts of ``loss_roles``, as they stand in the
    output), and the turns that made the template rewrite history.

    ``turns`` has conv_id, turn, role, text. Rows stand in order of turn (null
    first), then role and text; repeated rows are turns of their own. A null
    role or text is empty. Rows with a null conv_id form one conversation. An
    empty table gives no rows. Other columns are not read. A turn whose text
    the template hides is not under the mask, nor is any turn of a conversation
    that the template rewrites."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        pairs = lambda xs: [{"start": a, "end": b} for a, b in xs]
        for conv, own in _grouped(batches):
            found = locate(template, own, context)
            loss = [x for (role, _), x in zip(own, found.texts, strict=True) if x and role in loss_roles]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([found.formatted]), pa.array([pairs(found.spans)], spans_type),
                 pa.array([pairs(loss)], spans_type), pa.array([found.rewrites], pa.list_(pa.int64()))],
                names=["conv_id", "formatted", "spans", "loss", "rewrites"])

    ordered = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """Read the output of ``format_conversations`` (with its own template)
    back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                own = read_back(text)
                under = "".join(unescape(text[x["start"]:x["end"]]) for x in loss)
                said = "".join(f"{role}\n{words}\n" for role, words in own)
                rows.append((len(own), hashlib.sha256(said.encode()).hexdigest(), len(under),
                             hashlib.sha256(under.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
