"""Scalar expressions shared by the normalisation and aggregate operators.

All of them compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def percentage(count: Column | str, total: Column | str, decimals: int = 2) -> Column:
    """``count / total`` as a 0-100 share rounded half-up to ``decimals``.

    Same arithmetic order as the published helper: ((c / t) * 100) * 10^d,
    then floor(x + 0.5) / 10^d; a zero total gives 0.
    """
    c = _c(count).cast("double")
    t = _c(total).cast("double")
    factor = float(10 ** decimals)
    share = F.floor(c / t * F.lit(100.0) * F.lit(factor) + F.lit(0.5)) / F.lit(factor)
    return F.when(t == 0, F.lit(0.0)).otherwise(share.cast("double"))


def _rounded_decimal(text: Column) -> Column:
    # Numeric text -> nearest integer, half away from zero ('86.6' -> 87).
    return F.round(text.try_cast("decimal(38,9)"), 0)


def json_int(text: Column | str) -> Column:
    """TRY_CAST of JSON scalar text to INT with rounding of fractional text."""
    return _rounded_decimal(_c(text)).try_cast("int")


def json_long(text: Column | str) -> Column:
    """TRY_CAST of JSON scalar text to BIGINT with rounding of fractional text."""
    return _rounded_decimal(_c(text)).try_cast("bigint")


def flag(text: Column | str) -> Column:
    """Item flag: boolean text, absent or unparsable -> false."""
    return F.coalesce(_c(text).try_cast("boolean"), F.lit(False))


def first_value(named: Column | str, name: str) -> Column:
    """First entry of an array<struct<name, values>> whose name matches,
    then ``values[0][0]``; NULL when there is none (no error under ANSI)."""
    arr = _c(named)
    # array_position over the extracted names (1-based, 0 when absent) keeps
    # this a compiled expression instead of a per-element lambda.
    pos = F.array_position(arr["name"], F.lit(name))
    hit = F.get(arr, (pos - 1).cast("int"))
    return F.get(F.get(hit["values"], 0), 0)


def first_digits_int(text: Column | str) -> Column:
    """first run of digits as INT (sign dropped); no digits -> NULL."""
    digits = F.regexp_extract(_c(text), r"\d+", 0)
    return digits.try_cast("int")


def links(sockets_text: Column | str) -> Column:
    """Size of the largest socket link group (a missing group is its own
    group); no sockets -> 0. Evaluated per row with higher-order functions,
    so it never needs a join or a shuffle."""
    groups = F.from_json(_c(sockets_text), "array<struct<group:string>>")["group"]

    def largest(of: Column) -> Column:
        return F.array_max(F.transform(F.array_distinct(of), lambda g: F.size(F.filter(of, lambda x: x.eqNullSafe(g)))))
    # As a lambda's variable the text is parsed once, not again for every group.
    return F.coalesce(F.get(F.transform(F.array(groups), largest), 0), F.lit(0)).cast("int")


def character_key(account: Column | str = "account", character: Column | str = "character") -> Column:
    """F8: display key ``account || '/' || character``; NULL if either side is NULL."""
    return F.concat(_c(account), F.lit("/"), _c(character))


def iso_instant(ts: Column | str) -> Column:
    """render a timestamp as ISO-8601 UTC with milliseconds (session TZ UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def snapshot_id(instant_iso: Column | str) -> Column:
    """snapshot id from an ISO instant (``:`` and ``.`` -> ``-``)."""
    return F.regexp_replace(_c(instant_iso), r"[:.]", "-")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_ms_utc(ntz: Column | str) -> Column:
    """Milliseconds since the epoch of a zone-less timestamp read as UTC,
    whatever the session time zone (a difference of two zone-less values
    involves no zone)."""
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"),
                            _c(ntz).cast("timestamp_ntz"))
