"""Object-key layout: builders (P20), classifier (P18), parser (P19) and
content kind (F19), all as column expressions.

Fixed values below restate the storage layout the keys must follow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key prefixes of the storage layout.
INDEX_PATH = "index.json"
STATE_PREFIX = "state/"
TREE_PREFIX = "state/tree/"
RAW_PREFIX = "raw/"
SNAPSHOTS_PREFIX = "snapshots/"
ECONOMY_PREFIX = "economy/"

# The 15 key categories, in first-match order of the rules.
CATEGORIES = ["index", "economy", "raw", "tree", "roster", "snapshot-state", "worker-result",
              "chunk", "worker", "ip", "checkpoint", "detail", "agg", "meta", "other"]

# Key grammars that carry (league, snapshot id).
RE_DETAIL = r"^snapshots/([^/]+)/([^/]+)/detail/"
RE_RAW = r"^raw/([^/]+)/([^/]+)/"
RE_CHUNK = r"^state/([^/]+)/chunks/([^/]+)/"
RE_SNAPSHOT_STATE = r"^state/([^/]+)/snapshots/(.+)\.ndjson\.gz$"
RE_WORKER_RESULT = r"^state/([^/]+)/results/([^/]+)/"
RE_ROSTER = r"^state/[^/]+/roster\.json$"
RE_WORKER = r"^state/[^/]+/workers/"
RE_IP = r"^state/[^/]+/ips/"
RE_AGG = r"^snapshots/[^/]+/[^/]+/agg/"
RE_META = r"^snapshots/[^/]+/[^/]+/meta\.json$"

TRANSIENT = {"raw": RE_RAW, "chunk": RE_CHUNK, "snapshot-state": RE_SNAPSHOT_STATE,
             "worker-result": RE_WORKER_RESULT}
PARSERS = {"detail": RE_DETAIL, **TRANSIENT}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------- F16
def encode_segment(x: Column | str) -> Column:
    """URI-component encoding: ``url_encode`` (form encoding) adjusted so
    space is %20 and the characters left alone by component encoding
    (``! ~ ' ( )``) stay literal."""
    enc = F.url_encode(_c(x))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    for code, ch in (("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        enc = F.replace(enc, F.lit(code), F.lit(ch))
    return enc


# Text whose percent escapes are all well-formed UTF-8.
_T = "%[89ab][0-9a-f]"
WELL_ESCAPED = (r"(?is)^(?:[^%]|%[0-7][0-9a-f]|%(?:c[2-9a-f]|d[0-9a-f])" + _T + "|%e0%[ab][0-9a-f]" + _T
                + "|%e[1-9a-cef](?:" + _T + "){2}|%ed%[89][0-9a-f]" + _T + "|%f0%[9ab][0-9a-f](?:" + _T + "){2}"
                + "|%f[1-3](?:" + _T + "){3}|%f4%8[0-9a-f](?:" + _T + "){2})*+$")


def decode_segment(x: Column | str) -> Column:
    """URI-component decoding; an escape that is malformed or not UTF-8
    leaves the text as is. ``+`` is protected first because form decoding
    would turn it into a space."""
    raw = _c(x)
    return F.when(raw.rlike(WELL_ESCAPED), F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)


# ------------------------------------------------------------------- P20
def pad(n: Column, width: int) -> Column:
    """Zero-pad to at least ``width`` digits (never truncates)."""
    s = n.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def _league(league: Column | str) -> Column:
    return encode_segment(league)


def snapshot_state_key(league, snap) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/snapshots/"), _c(snap), F.lit(".ndjson.gz"))


def worker_result_prefix(league, snap) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/results/"), _c(snap), F.lit("/"))


def worker_result_key(league, snap, worker: Column) -> Column:
    return F.concat(worker_result_prefix(league, snap), F.lit("w"), pad(worker, 2), F.lit(".ndjson.gz"))


def chunk_prefix(league, snap) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/chunks/"), _c(snap), F.lit("/"))


def chunk_key(league, snap, chunk: Column) -> Column:
    return F.concat(chunk_prefix(league, snap), pad(chunk, 5), F.lit(".json"))


def raw_prefix(league, snap) -> Column:
    return F.concat(F.lit(RAW_PREFIX), _league(league), F.lit("/"), _c(snap), F.lit("/"))


def snapshot_prefix(league, snap) -> Column:
    return F.concat(F.lit(SNAPSHOTS_PREFIX), _league(league), F.lit("/"), _c(snap), F.lit("/"))


def detail_key(league, snap, table: Column) -> Column:
    return F.concat(snapshot_prefix(league, snap), F.lit("detail/"), table, F.lit(".parquet"))


def agg_key(league, snap, name: Column) -> Column:
    return F.concat(snapshot_prefix(league, snap), F.lit("agg/"), name, F.lit(".json"))


def meta_key(league, snap) -> Column:
    return F.concat(snapshot_prefix(league, snap), F.lit("meta.json"))


def checkpoint_key(league) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/current.json"))


def roster_key(league) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/roster.json"))


def worker_state_key(league, slot: Column) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/workers/"), encode_segment(slot),
                    F.lit(".json"))


def ip_pace_key(league, ip: Column) -> Column:
    return F.concat(F.lit(STATE_PREFIX), _league(league), F.lit("/ips/"), encode_segment(ip),
                    F.lit(".json"))


def tree_cache_key(version: Column) -> Column:
    return F.concat(F.lit(TREE_PREFIX), encode_segment(version), F.lit(".json"))


def economy_key(league) -> Column:
    return F.concat(F.lit(ECONOMY_PREFIX), _league(league), F.lit(".json"))


# ------------------------------------------------------------------- P18
def classify_key(key: Column | str = "key") -> Column:
    """First-match category of a key (``checkpoint`` is the catch-all of
    ``state/``)."""
    k = _c(key)
    return (F.when(k == INDEX_PATH, "index")
            .when(k.startswith(ECONOMY_PREFIX), "economy")
            .when(k.startswith(RAW_PREFIX), "raw")
            .when(k.startswith(TREE_PREFIX), "tree")
            .when(k.rlike(RE_ROSTER), "roster")
            .when(k.rlike(RE_SNAPSHOT_STATE), "snapshot-state")
            .when(k.rlike(RE_WORKER_RESULT), "worker-result")
            .when(k.rlike(RE_CHUNK), "chunk")
            .when(k.rlike(RE_WORKER), "worker")
            .when(k.rlike(RE_IP), "ip")
            .when(k.startswith(STATE_PREFIX), "checkpoint")
            .when(k.rlike(RE_DETAIL), "detail")
            .when(k.rlike(RE_AGG), "agg")
            .when(k.rlike(RE_META), "meta")
            .otherwise("other"))


# ------------------------------------------------------------------- P19
def parse_key(key: Column | str, grammar: str) -> tuple[Column, Column]:
    """(league, snapshot_id) of a key under one grammar; NULLs when the key
    does not match. The league is URI-decoded."""
    k = _c(key)
    pattern = PARSERS[grammar]
    hit = k.rlike(pattern)
    league = F.when(hit, decode_segment(F.regexp_extract(k, pattern, 1)))
    snap = F.when(hit, F.regexp_extract(k, pattern, 2))
    return league, snap


def parse_any(key: Column | str = "key") -> tuple[Column, Column]:
    """(league, snapshot_id) under whichever snapshot grammar matches."""
    leagues, snaps = zip(*(parse_key(key, g) for g in PARSERS))
    return F.coalesce(*leagues), F.coalesce(*snaps)


# ------------------------------------------------------------------- F19
def content_kind(key: Column | str = "key") -> Column:
    """Content type by extension."""
    k = _c(key)
    return (F.when(k.endswith(".json"), "application/json")
            .when(k.endswith(".parquet"), "application/vnd.apache.parquet")
            .when(k.endswith(".gz"), "application/gzip")
            .otherwise("application/octet-stream"))
