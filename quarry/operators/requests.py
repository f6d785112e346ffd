"""Request-log analytics: response classification (P21/P22), rate-limit
header parsing (F14/F15), sliding-window quota audit (W6), throttle/error
streaks with back-off (W7) and a rule summary (A18).

Log shape: ``(ts, ip, status, headers map<string,string>, body, seq)``;
header names are lower-case; ``seq`` totally orders requests of one ip that
share a timestamp.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import checkpoint_root, ship

# Markers of an edge challenge page and of an HTML body.
CHALLENGE_MARKERS = ["just a moment", "/cdn-cgi/challenge-platform", "cf-challenge", "__cf_chl"]
HTML_MARKERS = ["<!doctype html", "cloudflare", "just a moment"]
# Limiter defaults (ms) and abort thresholds.
THROTTLE_BACKOFF_MS = 5_000
ERROR_BACKOFF_MS = 2_000
MAX_BACKOFF_MS = 300_000
THROTTLE_ABORT = 3
ERROR_ABORT = 8
HEADROOM = 0.9
_MARK = "end-of-body-7c41f0"
_LONG_MAX = (1 << 63) - 1


# ------------------------------------------------------------------ P21
def _head(body: Column, n: int) -> Column:
    return F.lower(F.substring(F.regexp_replace(body, r"^\s+", ""), 1, n))


def is_json(body: Column) -> Column:
    """Whole-body JSON validity (scalars count, repeated keys do too). The
    body is parsed as the first element of an array that a mark closes: a
    second value, trailing text or a bracket of its own leaves no array of
    just the value and the mark."""
    wrapped = F.from_json(F.concat(F.lit("["), body, F.lit(f',"{_MARK}"]')), "array<string>",
                          {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    return F.coalesce((F.size(wrapped) == 2) & (F.get(wrapped, F.lit(1)) == _MARK), F.lit(False))


def looks_like_challenge(headers: Column, body: Column) -> Column:
    """edge challenge: flagged by header or by a marker in the head."""
    head = _head(body, 600)
    marker = F.lit(False)
    for m in CHALLENGE_MARKERS:
        marker = marker | head.contains(m)
    flagged = F.coalesce(F.length(headers["cf-mitigated"]) > 0, F.lit(False))
    return flagged | F.coalesce(marker, F.lit(False))


def looks_like_html(body: Column) -> Column:
    """HTML sniffing on the first 400 characters (lower-cased)."""
    head = _head(body, 400)
    hit = head.startswith("<")
    for m in HTML_MARKERS:
        hit = hit | head.contains(m)
    return F.coalesce(hit, F.lit(False))


def classify_response(df: DataFrame, status: str = "status", headers: str = "headers",
                      body: str = "body") -> DataFrame:
    """Category per response; JSON bodies are decided on status only."""
    s, b, h = F.col(status), F.coalesce(F.col(body), F.lit("")), F.col(headers)
    json_ok = is_json(b)
    cat = (F.when(s == 429, "rate_limited")
           .when(s >= 500, "server_error")
           .when(json_ok, F.when(s == 404, "dead").when(s == 403, "private")
                 .when(s >= 400, "client_error").otherwise("json"))
           .when(looks_like_challenge(h, b), "challenge")
           .when(s == 404, "dead")
           .when(s == 403, "private")
           .when(looks_like_html(b), "challenge")
           .otherwise("server_error"))
    return df.withColumn("category", cat)


def result_kind(category: Column | str = "category") -> Column:
    """Category -> character-call result kind."""
    c = F.col(category) if isinstance(category, str) else category
    return (F.when(c == "json", "ok").when(c.isin("private", "dead", "rate_limited"), c)
            .otherwise("retryable"))


def signal(category: Column | str = "category") -> Column:
    """Category -> pacing signal."""
    c = F.col(category) if isinstance(category, str) else category
    return (F.when(c == "rate_limited", "throttled").when(c == "challenge", "challenge")
            .when(c.isin("server_error", "client_error"), "error").otherwise("ok"))


# ------------------------------------------------------------------ F14 / F15
def _lead_int(x: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.trim(x), r"^[+-]?\d+", 0).try_cast("int"), F.lit(0))


def parse_tuples(value: Column) -> Column:
    """``hits:period:penalty,...`` -> array<struct<hits,periodSec,
    penaltySec>>; blank parts skipped, leading-int parse (bad -> 0),
    tuples with hits <= 0 or period <= 0 dropped."""
    parts = F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda p: F.trim(p)),
                     lambda p: F.length(p) > 0)
    tuples = F.transform(parts, lambda p: F.struct(
        _lead_int(F.get(F.split(p, ":"), 0)).alias("hits"),
        _lead_int(F.get(F.split(p, ":"), 1)).alias("periodSec"),
        _lead_int(F.get(F.split(p, ":"), 2)).alias("penaltySec")))
    return F.filter(tuples, lambda t: (t["hits"] > 0) & (t["periodSec"] > 0))


def rate_rules(headers: Column) -> Column:
    """Rules named by ``x-rate-limit-rules`` with their limit and state
    tuples; a rule without a limit header is skipped."""
    names = F.filter(F.transform(F.split(F.coalesce(headers["x-rate-limit-rules"], F.lit("")), ","),
                                 lambda n: F.trim(n)), lambda n: F.length(n) > 0)
    rules = F.transform(names, lambda n: F.struct(
        n.alias("name"),
        headers[F.concat(F.lit("x-rate-limit-"), F.lower(n))].alias("limit_raw"),
        headers[F.concat(F.lit("x-rate-limit-"), F.lower(n), F.lit("-state"))].alias("state_raw")))
    kept = F.filter(rules, lambda r: r["limit_raw"].isNotNull())
    return F.transform(kept, lambda r: F.struct(
        r["name"].alias("name"), parse_tuples(r["limit_raw"]).alias("limits"),
        parse_tuples(r["state_raw"]).alias("state")))


def retry_after_ms(headers: Column, now: Column) -> Column:
    """``Retry-After`` as delta-seconds or HTTP date -> ms to wait
    from ``now`` (a timestamp); absent, unparsable or past -> NULL. Seconds
    beyond the range of a long are the longest wait, not an error."""
    raw = F.trim(headers["retry-after"])
    secs = F.when(raw.rlike(r"^\d+$"), F.coalesce(F.try_multiply(raw.try_cast("long"), F.lit(1000).cast("long")),
                                                  F.lit(_LONG_MAX)))
    date = F.try_to_timestamp(F.regexp_replace(raw, r"^[A-Za-z]+, ", ""),
                              F.lit("dd MMM yyyy HH:mm:ss zzz"))
    delta = F.unix_millis(date) - F.unix_millis(now)
    return F.coalesce(secs, F.when(delta > 0, delta))


def windows_of(rules: Column, headroom: float = HEADROOM) -> Column:
    """Pacing windows (cap, period_ms) of every limit tuple of every rule."""
    return F.flatten(F.transform(rules, lambda r: F.transform(r["limits"], lambda t: F.struct(
        F.greatest(F.lit(1), F.floor(t["hits"] * F.lit(headroom)).cast("int")).alias("cap"),
        (t["periodSec"].cast("long") * 1000).alias("period_ms")))))


# ------------------------------------------------------------------ W6
def _audited(longest: int, names: list[str]):
    """Over requests sorted by (key, slice, time, seq), each slice with those
    of the slice before as halo: a row per request of the slice and window. One
    search over all groups of a batch finds the frames; the last group of a
    batch waits for the next one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def frames(rows: pa.Table) -> pa.RecordBatch:
            at, part = rows.column("__at").to_numpy(), rows.column("__slice").to_numpy()
            group = np.cumsum(_starts(rows))
            # Time within the group's two slices, groups one behind the other.
            place = group * (4 * longest) + (at - part * longest + longest)
            windows = rows.column("__w").combine_chunks()
            i = pc.list_parent_indices(windows).to_numpy()
            flat = windows.flatten()
            cap, period = flat.field("cap").to_numpy().astype(np.int64), flat.field("period_ms").to_numpy()
            hits = np.searchsorted(place, place[i], "right") - np.searchsorted(place, place[i] - period, "right")
            j = np.maximum(i - cap, 0)
            violation = (i >= cap) & (group[j] == group[i]) & (at[j] + period > at[i])
            kept = [rows.column(c).combine_chunks().take(pa.array(i)) for c in names]
            return pa.RecordBatch.from_arrays(
                [*kept, pa.array(cap, pa.int32()), pa.array(period, pa.int64()), pa.array(hits, pa.int64()), pa.array(violation),
                 pa.array(at[j] + period, pa.int64(), mask=~violation)], names=[*names, "cap", "period_ms", "hits", "violation", "earliest_ms"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = int(np.flatnonzero(_starts(held))[-1]) if len(held) else 0
            if last:
                yield frames(held.slice(0, last))
                held = held.slice(last)
        if held is not None and len(held):
            yield frames(held)

    return run


def _starts(rows: pa.Table) -> np.ndarray:
    """True at rows whose key or slice differs from the row before."""
    codes = rows.column("__key").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    part = rows.column("__slice").to_numpy()
    return np.concatenate([[True], (codes[1:] != codes[:-1]) | (part[1:] != part[:-1])])[:len(codes)]


def quota_audit(log: DataFrame, windows: Sequence[tuple[int, int]] | Column, by: str = "ip",
                ts_ms: str = "ts_ms", seq: str = "seq") -> DataFrame:
    """For each request and window (cap hits per period): ``hits`` =
    requests of the same key in (ts - period, ts] (peers included), and
    ``violation`` when the cap-th earlier request (order ts, seq) is less
    than a period old, with ``earliest_ms`` = when it should have been sent.
    Columns: ``by``, ``seq``, ``ts_ms``, cap, period_ms and these three.

    ``windows`` is a fixed list or, per request, a column of
    array<struct<cap, period_ms>> such as ``windows_of(rate_rules(headers))``.
    Headers are parsed once, into a narrow written table. Requests without a
    time are left out.

    A key's requests are dealt by time slices as long as the longest period,
    each with the slice before it as halo: no frame or cap reaches further
    back, so a slice is audited by itself after one shuffle and one sort, and
    a hot key spreads over its slices. A task holds one key's two slices."""
    spark = ship(log.sparkSession)
    wins = windows if isinstance(windows, Column) else F.array(*[
        F.struct(F.lit(int(c)).alias("cap"), F.lit(int(p)).cast("long").alias("period_ms"))
        for c, p in sorted(set(windows))])
    kind = "array<struct<cap:int,period_ms:long>>"
    own = log.select(F.col(by).alias("__by"), F.col(seq).alias("__seq"), F.col(ts_ms).cast("long").alias("__at"),
                     F.array_distinct(wins).cast(kind).alias("__w")).where(F.col("__at").isNotNull())
    path = checkpoint_root(spark, "quota-audit", unique=True)
    own.write.parquet(path)
    own = spark.read.schema(own.schema).parquet(path)
    longest = own.agg(F.max(F.array_max(F.col("__w.period_ms"))).alias("p")).first().p or 1
    at = F.floor(F.col("__at") / F.lit(longest))
    both = F.explode(F.array(F.struct(at.alias("s"), F.col("__w").alias("w")),
                             F.struct((at + 1).alias("s"), F.array().cast(kind).alias("w"))))
    dealt = (own.withColumn("__c", both).select(F.col("__by").alias("__key"), F.col("__seq"), "__at", F.col("__c.s").alias("__slice"),
                                                F.col("__c.w").alias("__w"))
             .repartition("__key", "__slice").sortWithinPartitions("__key", "__slice", "__at", "__seq"))
    types = own.schema
    names = ["__key", "__seq", "__at"]
    ddl = (f"__key {types['__by'].dataType.simpleString()}, __seq {types['__seq'].dataType.simpleString()}, __at long, "
           "cap int, period_ms long, hits long, violation boolean, earliest_ms long")
    found = dealt.mapInArrow(_audited(longest, names), ddl)
    return found.withColumnsRenamed({"__key": by, "__seq": seq, "__at": ts_ms})


# ------------------------------------------------------------------ W7
def _streaks(df: DataFrame, by: str, ts_ms: str, seq: str, hits: dict[str, Column],
             bucket_ms: int) -> DataFrame:
    """Length of the current run of each ``hits`` condition per key (0 on
    other rows), all runs in one sweep.

    run = idx - (index of the last row not meeting the condition), with both
    prefix quantities computed in two passes: window functions per (key,
    time bucket), then per-bucket carries from a small table of one row per
    (key, bucket). A hot key spreads over its buckets."""
    b = F.floor(F.col(ts_ms) / F.lit(bucket_ms))
    w_local = Window.partitionBy(by, "__b").orderBy(F.col(ts_ms), F.col(seq))
    w_run = w_local.rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("__b", b).withColumn("__i", F.row_number().over(w_local))
    names = list(hits)
    for n in names:
        local = local.withColumn(f"__h_{n}", hits[n])
        local = local.withColumn(f"__r_{n}", F.max(F.when(~F.col(f"__h_{n}"), F.col("__i"))).over(w_run))
    per_bucket = local.groupBy(by, "__b").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max(F.when(~F.col(f"__h_{n}"), F.col("__i"))).alias(f"__lr_{n}") for n in names])
    w_prev = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carries = per_bucket.withColumn("__off", F.coalesce(F.sum("__n").over(w_prev), F.lit(0)))
    for n in names:
        carries = carries.withColumn(
            f"__c_{n}", F.coalesce(F.max(F.col("__off") + F.col(f"__lr_{n}")).over(w_prev), F.lit(0)))
    carries = carries.select(by, "__b", "__off", *[f"__c_{n}" for n in names])
    j = local.join(carries, [by, "__b"])
    for n in names:
        last_reset = F.coalesce(F.col("__off") + F.col(f"__r_{n}"), F.col(f"__c_{n}"))
        run = F.when(F.col(f"__h_{n}"), F.col("__off") + F.col("__i") - last_reset).otherwise(F.lit(0))
        j = j.withColumn(n, run.cast("long"))
    return j.drop("__b", "__i", "__off", *[f"__{x}_{n}" for n in names for x in ("h", "r", "c")])


def danger_streaks(log: DataFrame, by: str = "ip", ts_ms: str = "ts_ms", seq: str = "seq",
                   signal_col: str = "signal", retry_col: str = "retry_ms",
                   bucket_ms: int = 3_600_000) -> DataFrame:
    """Consecutive throttle/challenge run (reset by ok or error) and
    consecutive error run (reset by ok or throttle), the back-off each
    response earns (Retry-After, else base * 2^(n-1), capped) and the abort
    flags at 3 throttles / 8 errors. Runs are measured with skew-safe
    two-pass prefix computations (see ``_streaks``)."""
    sig = F.col(signal_col)
    thr = sig.isin("throttled", "challenge")
    err = sig == "error"
    df = _streaks(log, by, ts_ms, seq, {"throttle_streak": thr, "error_streak": err}, bucket_ms)
    escalated = (F.when(thr, F.lit(THROTTLE_BACKOFF_MS) * F.pow(F.lit(2), F.col("throttle_streak") - 1))
                 .when(err, F.lit(ERROR_BACKOFF_MS) * F.pow(F.lit(2), F.col("error_streak") - 1)))
    backoff = F.least(F.lit(MAX_BACKOFF_MS).cast("double"),
                      F.coalesce(F.col(retry_col).cast("double"), escalated))
    return (df.withColumn("backoff_ms", F.when(thr | err, backoff.cast("long")))
            .withColumn("abort", (F.col("throttle_streak") >= THROTTLE_ABORT)
                        | (F.col("error_streak") >= ERROR_ABORT)))


# ------------------------------------------------------------------ A18
def rate_rule_summary(log: DataFrame, headers: str = "headers") -> DataFrame:
    """Per rule and limit tuple, how often it was advertised, plus the
    largest active restriction (state penalty seconds) reported."""
    rules = log.select(F.explode(rate_rules(F.col(headers))).alias("r"))
    limits = rules.select(F.col("r.name").alias("rule"), F.explode("r.limits").alias("t"))
    per_tuple = limits.groupBy("rule", F.col("t.hits").alias("hits"),
                               F.col("t.periodSec").alias("period_sec"),
                               F.col("t.penaltySec").alias("penalty_sec")) \
        .agg(F.count(F.lit(1)).alias("responses"))
    states = rules.select(F.col("r.name").alias("rule"), F.explode("r.state").alias("s"))
    worst = states.groupBy("rule").agg(F.max("s.penaltySec").alias("max_restriction_sec"))
    return per_tuple.join(worst, "rule", "left").withColumn(
        "max_restriction_sec", F.coalesce("max_restriction_sec", F.lit(0)))
