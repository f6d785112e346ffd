"""Quality rules: line-first cleaning.

Every line of a text is judged by punctuation, navigation and boilerplate
rules; failing lines are removed, and a document that loses too large a share
of its words is rejected. Base measures of the whole text (counts, repeated
lines, repeated word windows) come with it.

Each document is judged alone, so the operator is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import WORD_RE, text_chunks

#: Tokens that separate the entries of a menu or a bread crumb.
SEPARATORS = ("|", "||", ">", ">>", "»", "›", "•", "·", "/", "-", "–", "—", "→")
#: Phrases of site furniture (lower case).
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "uses cookies", "privacy policy",
    "terms of service", "terms of use", "terms and conditions", "enable javascript", "lorem ipsum",
    "licensed under", "subscribe to our newsletter", "sign up for our", "click here to",
    "share on facebook", "share this page", "follow us on", "skip to content", "powered by",
)
#: A line whose last sign is one of these, or one of these before closing quotes or brackets, is a sentence.
TERMINAL_RE = r"[.!?…。！？:;][\"'”’»)\]]*[\x20\x09-\x0D]*$"
#: A word with doubled symbols or doubled exclamation or question marks.
NOISY_RE = r"[^\x20\x09-\x0D]*(?:[#*$%&|<>{}~^=\\]{2}|[!?]{2})[^\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Rules:
    """Thresholds. ``max_fragment_words``: a line without terminal punctuation
    fails when it has at most so many words. ``nav_percent``: share of
    separator tokens that makes a menu. ``max_boilerplate_words``: longer
    lines are prose that mentions a phrase. ``noisy_percent``: share of words
    with doubled symbols. ``max_loss_percent``: words a kept document may lose.
    ``min_words`` and ``max_repeat_percent``: the base rules."""

    max_fragment_words: int = 7
    nav_percent: int = 20
    max_boilerplate_words: int = 30
    noisy_percent: int = 30
    max_loss_percent: int = 30
    min_words: int = 50
    max_repeat_percent: int = 50


_word, _terminal, _noisy = re.compile(WORD_RE), re.compile(TERMINAL_RE), re.compile(NOISY_RE)
_symbols = re.compile(r"[#*$%&|<>]")
_boilerplate = re.compile("|".join(map(re.escape, BOILERPLATE)))
_separators = frozenset(SEPARATORS)
_ascii_lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def failed_rule(line: str, words: list[str], rules: Rules) -> str | None:
    """The first rule that the line fails, or None."""
    n = len(words)
    if 100 * sum(w in _separators for w in words) >= rules.nav_percent * n:
        return "navigation"
    if 100 * len(_noisy.findall(line)) >= rules.noisy_percent * n:
        return "punctuation"
    if n <= rules.max_fragment_words and not _terminal.search(line):
        return "punctuation"
    if n <= rules.max_boilerplate_words and _boilerplate.search(line.translate(_ascii_lower)):
        return "boilerplate"
    return None


def repeated_words(words: list[str]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    v = len(ids)
    key = a[:-2] * v + a[1:-1]
    if v >= 2_000_000:  # v ** 3 would leave 64 bits
        key = np.unique(key, return_inverse=True)[1]
    _, inverse, counts = np.unique(key * v + a[2:], return_inverse=True, return_counts=True)
    often = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= often
    return int(covered.sum())


def judge(text: str | None, rules: Rules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, removed_words, removed_lines, clean text)."""
    text = text or ""
    seen: set[str] = set()
    all_words: list[str] = []
    clean: list[str] = []
    duplicates = removed_words = removed_lines = 0
    for line in text.split("\n"):
        words = _word.findall(line)
        if words:
            duplicates += line in seen
            seen.add(line)
            all_words += words
            if failed_rule(line, words, rules):
                removed_words += len(words)
                removed_lines += 1
                continue
        clean.append(line)
    n, repeated = len(all_words), repeated_words(all_words)
    base_failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    kept = not base_failed and 100 * removed_words <= rules.max_loss_percent * n
    return (n, sum(map(len, all_words)), len(_symbols.findall(text)), duplicates, repeated,
            base_failed, kept, removed_words, removed_lines, "\n".join(clean))


_FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
           ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
           ("kept", pa.bool_()), ("n_removed_words", pa.int64()), ("n_removed_lines", pa.int64()),
           ("clean_text", pa.string()))
_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, n_removed_words long, n_removed_lines long, clean_text string")


def line_first_rules(docs: DataFrame, rules: Rules = Rules(), text: str = "text",
                     keep: tuple[str, ...] = ("doc_id",), with_text: bool = True) -> DataFrame:
    """Judge every document of ``docs``: one output row per input row, the
    columns ``keep`` followed by the measures, the verdict and the clean text
    (left out unless ``with_text``).

    Null or empty text: no words, ``base_failed``. Very long texts are judged
    whole. Repeated rows give repeated results. An empty table gives an empty
    result. Other columns of ``docs``, whatever their names, are not read; a
    ``keep`` column named like a result column is an error Spark reports."""
    wanted = [(n, t) for n, t in _FIELDS if with_text or n != "clean_text"]
    source = docs.select(*keep, docs[text].alias("__text"))
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ddl = f"{keys}, {_DDL if with_text else _DDL.rsplit(',', 1)[0]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "__text", 1_000_000):
            rows = [judge(t, rules) for t in batch.column("__text").to_pylist()]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(c, t) for c, (_, t) in zip(columns, wanted, strict=False)],
                names=[*keep, *(n for n, _ in wanted)])

    return source.mapInArrow(run, ddl)
