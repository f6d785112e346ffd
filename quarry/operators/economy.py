"""Economy cache planning: active league selection (P15/U4), completeness of
the price-category catalogue per league (J8), the per-league report (A16)
and the all-or-nothing publish filter (V4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The economy endpoint groups and their category types
# (16 + 25 + 2 = 43 pairs), in catalogue order.
ECONOMY_ENDPOINTS = {
    "exchange": ["Currency", "Fragment", "Runegraft", "AllflameEmber", "Tattoo", "Omen",
                 "DjinnCoin", "DivinationCard", "Artifact", "Oil", "DeliriumOrb", "Scarab",
                 "Astrolabe", "Fossil", "Resonator", "Essence"],
    "stashItem": ["Wombgift", "Incubator", "UniqueWeapon", "UniqueArmour", "UniqueAccessory",
                  "UniqueFlask", "UniqueJewel", "ForbiddenJewel", "ShrineBelt", "UniqueTincture",
                  "UniqueRelic", "SkillGem", "ImbuedGem", "ClusterJewel", "Map", "BlightedMap",
                  "BlightRavagedMap", "UniqueMap", "ValdoMap", "Invitation", "Memory",
                  "IncursionTemple", "BaseType", "Beast", "Vial"],
    "stashCurrency": ["Currency", "Fragment"],
}
CATALOGUE_PAIRS = [(ep, t) for ep, types in ECONOMY_ENDPOINTS.items() for t in types]
PERMANENT_LEAGUE = "Standard"


def catalogue(spark: SparkSession) -> DataFrame:
    """The 43 (endpoint, type) pairs with their catalogue position."""
    return spark.createDataFrame([(i, ep, t) for i, (ep, t) in enumerate(CATALOGUE_PAIRS)],
                                 "pair_pos int, endpoint string, type string")


def active_leagues(leagues: DataFrame, now: str, permanent: str = PERMANENT_LEAGUE,
                   pos: str = "pos") -> DataFrame:
    """P15 + U4: temporary leagues that have started and not ended at
    ``now``, deduped by id in first-seen order, then the permanent league
    last unless already present. Unparsable instants never exclude a row
    (they compare false both ways)."""
    now_ts = F.lit(now).try_cast("timestamp")
    start = F.try_to_timestamp(F.col("start_at"))
    end = F.try_to_timestamp(F.col("end_at"))
    keep = ((F.coalesce(F.col("category_id"), F.lit("")) != permanent)
            & F.col("start_at").isNotNull()
            & ~F.coalesce(start > now_ts, F.lit(False))
            & ~(F.col("end_at").isNotNull() & F.coalesce(end <= now_ts, F.lit(False))))
    kept = leagues.where(keep)
    first = kept.groupBy("id").agg(F.min(pos).alias("pos"))
    spark = leagues.sparkSession
    perm = spark.range(1).select(F.lit(permanent).alias("id"),
                                 F.lit(None).cast(first.schema["pos"].dataType).alias("pos"))
    perm = perm.join(first, "id", "left_anti")
    ordered = first.unionByName(perm)
    w = Window.orderBy(F.col("pos").asc_nulls_last(), F.col("id"))
    # The selected set is one row per league (small), so one ordered frame is fine.
    return ordered.select("id", (F.row_number().over(w) - 1).alias("position"))


def economy_completeness(leagues: DataFrame, responses: DataFrame) -> DataFrame:
    """Per league, every catalogue pair with whether an ok (200)
    response was fetched and, if not, why: the latest status seen or
    'not fetched'. The catalogue side is a fixed 43 rows (broadcast)."""
    spark = leagues.sparkSession
    pairs = leagues.select(F.col("id").alias("league")).crossJoin(F.broadcast(catalogue(spark)))
    seen = responses.groupBy("league", "endpoint", "type").agg(
        F.max(F.col("status") == 200).alias("fetched"),
        F.max_by("status", F.struct("ts", "seq")).alias("last_status"))
    j = pairs.join(seen, ["league", "endpoint", "type"], "left")
    fetched = F.coalesce(F.col("fetched"), F.lit(False))
    st = F.col("last_status")
    reason = (F.when(fetched, F.lit(None).cast("string"))
              .when(st.isNull(), F.lit("not fetched"))
              .when(st == 429, F.lit("throttled (429)"))
              .when(st >= 500, F.concat(F.lit("server error ("), st.cast("string"), F.lit(")")))
              .otherwise(F.concat(F.lit("unexpected status "), st.cast("string"))))
    return j.select("league", "pair_pos", "endpoint", "type", fetched.alias("fetched"),
                    reason.alias("reason"))


# Longest Retry-After honoured for a category fetch (ms).
MAX_RETRY_WAIT_MS = 60_000


def economy_backoff_ms(status: Column, attempt: Column, retry_after: Column) -> Column:
    """wait before the next attempt of a category fetch: on 429 the
    Retry-After seconds (capped at 60 s) or 2^attempt s; on 5xx 2^attempt s;
    NULL when no retry follows (ok or another 4xx)."""
    exp = F.pow(F.lit(2.0), attempt.cast("double")) * 1000
    ra = retry_after.try_cast("double")
    on_429 = F.when(ra.isNotNull() & ~F.isnan(ra), F.least(ra * 1000, F.lit(float(MAX_RETRY_WAIT_MS)))) \
        .otherwise(exp)
    return (F.when(status == 429, on_429).when(status >= 500, exp)).cast("long")


def economy_league_report(completeness: DataFrame) -> DataFrame:
    """A16 + V4: per league, categories fetched, failures (sorted by
    catalogue position) and whether the document may be written (no
    failure: all or nothing)."""
    failed = F.struct("pair_pos", "endpoint", "type", "reason")
    rep = completeness.groupBy("league").agg(
        F.count_if("fetched").alias("categories_fetched"),
        F.array_sort(F.collect_list(F.when(~F.col("fetched"), failed))).alias("failures"))
    return rep.withColumn("written", F.size("failures") == 0)


def publish_complete_leagues(report: DataFrame) -> DataFrame:
    """V4: only leagues without failures are written; others keep their
    last good document."""
    return report.where(F.col("written"))
