"""Snapshot state operators: seed, pending scan, worker assignment, the
outcome policy, result lines, last-write-wins merge and close-out.

State is a DataFrame of lines keyed by identity (account, character) with an
explicit ``ordinal`` (DataFrames have no line order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import latest_per_key, with_global_ordinal

IDENTITY = ("account", "character")
# Outcomes still awaiting a terminal result, and terminal ones.
PENDING_OUTCOMES = ["pending", "retryable"]
TERMINAL_OUTCOMES = ["ok", "private", "dead", "skipped"]
STATE_COLUMNS = ["ordinal", "rank", "account", "character", "class", "level", "outcome",
                 "attempts", "fetchedAt", "characterData", "passiveTree"]


def seed_state(roster: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Every roster row becomes a pending line (attempts 0); line 0 is
    the top of ``order``. The ordinal is assigned with the two-pass global
    ranking (no single-partition window)."""
    seeded = (roster.withColumn("outcome", F.lit("pending"))
              .withColumn("attempts", F.lit(0))
              .withColumn("fetchedAt", F.lit(None).cast("string"))
              .withColumn("characterData", F.lit(None).cast("string"))
              .withColumn("passiveTree", F.lit(None).cast("string")))
    return with_global_ordinal(seeded, order).select(*STATE_COLUMNS)


def pending_identities(state: DataFrame) -> DataFrame:
    """P5: identities still to resolve, payload columns pruned; the ordinal
    counts every line (it is the stored one, not a re-numbering)."""
    return (state.where(F.col("outcome").isin(*PENDING_OUTCOMES))
            .select("ordinal", "rank", "account", "character", "class", "level", "outcome",
                    "attempts"))


def assign(df: DataFrame, workers: int, ordinal: str = "ordinal") -> DataFrame:
    """Disjoint, complete, stable split: ``slot = ordinal mod workers``."""
    return df.withColumn("slot", F.pmod(F.col(ordinal), F.lit(workers)).cast("int"))


def mark_remaining_skipped(state: DataFrame) -> DataFrame:
    """pending/retryable -> skipped (terminal); others untouched."""
    return state.withColumn(
        "outcome", F.when(F.col("outcome").isin(*PENDING_OUTCOMES), F.lit("skipped"))
        .otherwise(F.col("outcome")))


def next_outcome(df: DataFrame, max_attempts: int, items_kind: str = "items_kind",
                 passives_kind: str = "passives_kind") -> DataFrame:
    """Apply one resolution attempt to (outcome, attempts).

    The passives call only happens when the items call is ok; the first
    non-ok kind decides: private/dead are terminal and burn an attempt,
    retryable burns one and turns dead at ``max_attempts``, rate_limited
    changes nothing; ok needs both calls ok.
    """
    ik, pk = F.col(items_kind), F.col(passives_kind)
    kind = F.when(ik != "ok", ik).when(pk != "ok", pk).otherwise(F.lit("ok"))
    burned = F.col("attempts") + 1
    outcome = (F.when(kind == "rate_limited", F.col("outcome"))
               .when(kind == "retryable", F.when(burned >= max_attempts, F.lit("dead"))
                     .otherwise(F.lit("retryable")))
               .when(kind.isin("ok", "private", "dead"), kind)
               .otherwise(F.col("outcome")))
    attempts = F.when(kind.isin("ok", "private", "dead", "retryable"), burned) \
        .otherwise(F.col("attempts"))
    return df.withColumn("next_outcome", outcome).withColumn("next_attempts", attempts.cast("int"))


def result_lines(before: DataFrame, after: DataFrame, keys: Sequence[str] = IDENTITY
                 ) -> DataFrame:
    """P10: only lines whose outcome or attempts changed; payloads only on ok."""
    b = before.select(*keys, F.col("outcome").alias("__bo"), F.col("attempts").alias("__ba"))
    j = after.join(b, list(keys), "inner")
    changed = j.where(~F.col("outcome").eqNullSafe(F.col("__bo"))
                      | ~F.col("attempts").eqNullSafe(F.col("__ba")))
    out = changed.drop("__bo", "__ba")
    for payload in ("characterData", "passiveTree"):
        if payload in out.columns:
            out = out.withColumn(payload, F.when(F.col("outcome") == "ok", F.col(payload)))
    return out


def merge_results(state: DataFrame, results: DataFrame, keys: Sequence[str] = IDENTITY,
                  order: Sequence[str] = ("file", "seq")) -> DataFrame:
    """Last write per identity wins and replaces the whole line; results
    for unknown identities are ignored; line order (ordinal) is kept.

    Results are reduced to one line per identity with a skew-safe aggregate,
    then joined to the state on the identity; adaptive execution makes it a
    broadcast join when the reduced side turns out small.
    Re-merging the same results is a no-op (idempotent).
    """
    keys = list(keys)
    payload = [c for c in STATE_COLUMNS if c not in keys and c != "ordinal" and c in results.columns]
    latest = latest_per_key(results.select(*keys, *payload, *order), keys, list(order)) \
        .drop(*order)
    r = latest.select(*keys, *[F.col(c).alias(f"__r_{c}") for c in payload],
                      F.lit(True).alias("__hit"))
    j = state.join(r, keys, "left")
    cols = []
    for c in state.columns:
        if c in payload:
            cols.append(F.when(F.col("__hit"), F.col(f"__r_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def _newer(rows: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(the rows that ``changes`` name, those of them with a change that is
    newer by ``order``): keys and narrow columns only, no row is shuffled."""
    hit = rows.join(F.broadcast(changes.select(*keys)), list(keys), "left_semi")
    had = hit.select(*keys, "outcome", *[F.col(c).alias(f"__had_{c}") for c in order])
    newer = F.col(f"__had_{order[0]}").isNull() | (F.struct(*[F.col(f"__had_{c}") for c in order]) < F.struct(*order))
    won = (changes.select(*keys, *order, F.col("outcome").alias("__new")).join(F.broadcast(had), list(keys)).where(newer)
           .select(*keys, F.col("outcome").alias("__old"), "__new"))
    return hit, won


def replace_lines(rows: DataFrame, changes: DataFrame, keys: Sequence[str] = IDENTITY,
                  order: Sequence[str] = ("file", "seq")) -> DataFrame:
    """J3 over some buckets of a stored state, whose lines keep the ``order``
    of their last result: a newer result replaces the line, its ordinal stays;
    older, repeated and unknown ones change nothing. ``changes`` has one row
    per identity."""
    keys = list(keys)
    payload = [c for c in rows.columns if c in changes.columns and c not in (*keys, "__bucket")]
    hit, won = _newer(rows, changes, keys, order)
    kept = hit.select(*keys, *[c for c in rows.columns if c not in keys and c not in payload])
    names = F.broadcast(won.select(*keys))
    new = changes.select(*keys, *payload).join(names, keys, "left_semi").join(F.broadcast(kept), keys)
    return rows.join(names, keys, "left_anti").unionByName(new.select(*rows.columns))


def tally_deltas(rows: DataFrame, changes: DataFrame, keys: Sequence[str] = IDENTITY,
                 order: Sequence[str] = ("file", "seq")) -> DataFrame:
    """What ``replace_lines`` changes in the tally, as (outcome, delta):
    old lines out, new lines in."""
    _, won = _newer(rows, changes, list(keys), order)
    signed = won.select(F.explode(F.array(F.struct(F.col("__old").alias("outcome"), F.lit(-1).cast("long").alias("d")),
                                          F.struct(F.col("__new").alias("outcome"), F.lit(1).cast("long").alias("d")))).alias("x"))
    return signed.groupBy("x.outcome").agg(F.sum("x.d").alias("delta"))
