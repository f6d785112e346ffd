"""Roster operators: ladder page scan (S11), atomic page stitching (S12),
upsert of a capture into the roster (J4) and the roster order (O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.common import latest_per_key

IDENTITY = ["account", "character"]

_PAGE = ("struct<total:variant,entries:array<struct<rank:variant,"
         "character:struct<name:variant,level:variant,class:variant>,account:struct<name:variant>>>>")


def _text(v: Column) -> Column:
    """A JSON string, else NULL."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _number(v: Column) -> Column:
    """A JSON number as int, else NULL."""
    numeric = F.schema_of_variant(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(numeric, F.try_variant_get(v, "$", "int"))


def _kept(e: Column) -> Column:
    return (F.coalesce(F.schema_of_variant(e["account"]["name"]) == "STRING", F.lit(False))
            & F.coalesce(F.schema_of_variant(e["character"]["name"]) == "STRING", F.lit(False)))


def _parse_pages(pages: DataFrame, by: Sequence[str], offset: str, doc: str) -> DataFrame:
    return pages.select(*by, F.col(offset).cast("long").alias("offset"),
                        F.from_json(F.col(doc), _PAGE).alias("p"),
                        F.try_variant_get(F.try_parse_json(F.col(doc)), "$.entries", "variant").isNull()
                        .alias("malformed"))


def _entries(parsed: DataFrame, by: list[str]) -> DataFrame:
    ex = parsed.select(*by, "offset", _number(F.col("p.total")).alias("total_raw"),
                       F.size(F.filter("p.entries", _kept)).alias("n_kept"),
                       F.posexplode("p.entries").alias("pos", "e"))
    kept = ex.where(_kept(F.col("e")))
    return kept.select(
        *by, "offset", "pos",
        F.coalesce(_number(F.col("e.rank")), F.lit(0)).alias("rank"),
        _text(F.col("e.account.name")).alias("account"),
        _text(F.col("e.character.name")).alias("character"),
        F.coalesce(_text(F.col("e.character.class")), F.lit("Unknown")).alias("class"),
        F.coalesce(_number(F.col("e.character.level")), F.lit(0)).alias("level"),
        F.coalesce(F.col("total_raw"), F.col("n_kept")).cast("long").alias("total"))


def scan_ladder_pages(pages: DataFrame, by: Sequence[str] = (), offset: str = "offset",
                      doc: str = "doc") -> DataFrame:
    """Explode captured pages into entries (by..., offset, pos, ...).

    Entries whose account or character name is not a JSON string are dropped;
    defaults: rank 0, class 'Unknown', level 0, also for values of another
    JSON kind; ``total`` defaults to the number of kept entries of the page.
    A page without ``entries`` is malformed; ``entries`` of another kind than
    an array are none."""
    by = list(by)
    return _entries(_parse_pages(pages, by, offset, doc), by)


def ladder_window(pages: DataFrame, depth: int, page_size: int, by: Sequence[str] = (),
                  offset: str = "offset", doc: str = "doc") -> DataFrame:
    """Stitch each capture's pages (offsets 0, page, 2*page ... below
    ``depth``) in offset order. After a page, the capture stops if the page
    kept no entry or the entries gathered so far reach that page's total.
    All or nothing: a missing or malformed page among the needed ones voids
    the whole capture. Pages at other offsets, or at ``depth`` and beyond,
    were never asked for and are left out; of the last page the first
    ``depth - offset`` entries count. Returns the entries of complete captures.

    Page bookkeeping is one row per (capture, offset): depth/page rows per
    capture, so its ordered frame stays tiny whatever the data size."""
    by = list(by)
    spark = pages.sparkSession
    at = F.col(offset)
    asked = pages.where((at >= 0) & (at < depth) & (at % page_size == 0))
    limit = (F.lit(depth) - F.col("offset")).cast("int")
    parsed = _parse_pages(asked, by, offset, doc).withColumn("p", F.when(F.col("p").isNotNull(), F.struct(
        F.col("p.total").alias("total"), F.slice("p.entries", F.lit(1), limit).alias("entries"))))
    entries = _entries(parsed, by)
    n_kept = F.greatest(F.coalesce(F.size(F.filter("p.entries", _kept)), F.lit(0)), F.lit(0))
    summary = parsed.select(*by, "offset", "malformed", n_kept.alias("n"),
                            F.coalesce(_number(F.col("p.total")), n_kept).cast("long").alias("total"),
                            F.lit(True).alias("present"))
    captures = pages.select(*by).distinct()
    expected = captures.crossJoin(
        F.broadcast(spark.range(0, depth, page_size).select(F.col("id").alias("offset"))))
    st = (expected.join(summary, [*by, "offset"], "left")
          .select(*by, "offset", F.coalesce("n", F.lit(0)).alias("n"), "total",
                  (F.col("present").isNull() | F.coalesce(F.col("malformed"), F.lit(False))).alias("bad")))
    w = Window.partitionBy(*by).orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    st = st.withColumn("cum", F.sum("n").over(w))
    stops = st.groupBy(*by).agg(F.min(F.when((F.col("n") == 0) | (F.col("cum") >= F.col("total")),
                                             F.col("offset"))).alias("stop"))
    needed = st.join(stops, by, "inner") if by else st.crossJoin(stops)
    needed = needed.where(F.col("stop").isNull() | (F.col("offset") <= F.col("stop")))
    void = needed.groupBy(*by).agg(F.max(F.col("bad").cast("int")).alias("void"))
    ok = (stops.join(void, by, "inner") if by else stops.crossJoin(void)).where(F.col("void") == 0)
    joined = entries.join(ok, by, "inner") if by else entries.crossJoin(ok)
    return joined.where(F.col("stop").isNull() | (F.col("offset") <= F.col("stop"))) \
        .drop("stop", "void")


def merge_ladder(roster: DataFrame, entries: DataFrame, now: str,
                 order: tuple[str, ...] = ("offset", "pos")) -> tuple[DataFrame, DataFrame]:
    """Upsert a capture: known identities get class/level/rank and
    lastSeenAt refreshed (firstSeenAt kept), new ones are appended with both
    stamps = ``now``. A repeated identity inside one capture: the last
    entry wins and counts as refreshed.

    Returns (roster, counts[added, refreshed])."""
    latest = latest_per_key(entries.select(*IDENTITY, "class", "level", "rank", *order),
                            IDENTITY, list(order)).drop(*order)
    e = latest.select(*IDENTITY, *[F.col(c).alias(f"__e_{c}") for c in ("class", "level", "rank")],
                      F.lit(True).alias("__seen"))
    r = roster.withColumn("__known", F.lit(True))
    j = r.join(e, IDENTITY, "full_outer")
    seen = F.coalesce(F.col("__seen"), F.lit(False))
    merged = j.select(
        *IDENTITY,
        *[F.when(seen, F.col(f"__e_{c}")).otherwise(F.col(c)).alias(c) for c in ("class", "level", "rank")],
        F.when(F.col("__known"), F.col("firstSeenAt")).otherwise(F.lit(now)).alias("firstSeenAt"),
        F.when(seen, F.lit(now)).otherwise(F.col("lastSeenAt")).alias("lastSeenAt"),
    )
    added = j.agg(F.count_if(F.col("__seen") & F.col("__known").isNull()).alias("added"))
    n_entries = entries.agg(F.count(F.lit(1)).alias("entries"))
    counts = added.crossJoin(n_entries).select(
        "added", (F.col("entries") - F.col("added")).alias("refreshed"))
    return merged, counts


def upsert_rows(now: str):
    """J4 over some buckets of a stored roster: ``(rows, changes) -> rows`` with
    known identities refreshed and new ones appended; no row is shuffled."""
    def merged(rows: DataFrame, changes: DataFrame) -> DataFrame:
        names = F.broadcast(changes.select(*IDENTITY))
        known = rows.join(names, list(IDENTITY), "left_semi").select(*IDENTITY, F.col("firstSeenAt").alias("__first"), F.lit(True).alias("__known"))
        fresh = changes.join(F.broadcast(known), list(IDENTITY), "left").select(
            *IDENTITY, "class", "level", "rank", F.when(F.col("__known"), F.col("__first")).otherwise(F.lit(now)).alias("firstSeenAt"),
            F.lit(now).alias("lastSeenAt"), "__bucket")
        return rows.join(names, list(IDENTITY), "left_anti").unionByName(fresh.select(*rows.columns))

    return merged


def latest_entries(entries: DataFrame, order: tuple[str, ...] = ("offset", "pos")) -> DataFrame:
    """A capture reduced to one row per identity: the last entry wins."""
    return latest_per_key(entries.select(*IDENTITY, "class", "level", "rank", *order), IDENTITY, list(order)).drop(*order)


def order_roster(roster: DataFrame) -> DataFrame:
    """O3: rank ascending, then firstSeenAt, then the identity key, with
    locale-aware string comparison (F13: UNICODE collation)."""
    return roster.orderBy(*roster_keys())


def roster_keys() -> list[Column]:
    """The sort keys of O3."""
    key = F.concat(F.col("account"), F.lit("\u0000"), F.col("character"))
    return [F.col("rank").asc(), F.collate(F.col("firstSeenAt"), "UNICODE"), F.collate(key, "UNICODE")]
