"""Storage inventory and retention planning over an object listing
``(key, size)`` and the manifests table.

Everything here is a plan (DataFrames of keys to delete / snapshots to
trim); executing deletes is the caller's filesystem step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import keys as K
from quarry.operators.common import with_global_ordinal, with_running_total
from quarry.session import ensure_checkpoint_dir
from quarry.schemas import IN_FLIGHT_PHASES, LIVE_PHASES, SCHEMA_VERSION


# ------------------------------------------------------------ P11 - P17
def in_flight(manifests: DataFrame) -> DataFrame:
    """Manifests of snapshots still being built."""
    return manifests.where(F.col("phase").isin(*IN_FLIGHT_PHASES))


def live_snapshots(manifests: DataFrame) -> DataFrame:
    """In flight past ladder capture."""
    return manifests.where(F.col("phase").isin(*LIVE_PHASES))


def _epoch_ms(iso: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(iso))


def aged(manifests: DataFrame, now: str, max_hours: float) -> Column:
    """Now - ladderCapturedAt > max age (strictly greater)."""
    return (_epoch_ms(F.lit(now)) - _epoch_ms(F.col("ladderCapturedAt"))) > F.lit(max_hours * 3_600_000)


def cooldown(now: str, hours: float) -> Column:
    """An abort younger than ``hours`` blocks a new snapshot."""
    return (_epoch_ms(F.lit(now)) - _epoch_ms(F.col("abortedAt"))) < F.lit(hours * 3_600_000)


def stale_pace(df: DataFrame, now: str, ttl_ms: int) -> DataFrame:
    """Stale when unreadable, or when now - updatedAt > ttl; a readable
    entry whose timestamp does not parse is kept (not stale)."""
    age = _epoch_ms(F.lit(now)) - _epoch_ms(F.col("updatedAt"))
    return df.withColumn("stale", ~F.col("readable") | F.coalesce(age > ttl_ms, F.lit(False)))


def pick_league(manifests: DataFrame, configured: str) -> DataFrame:
    """The configured league if it has a snapshot in flight, else the
    first in-flight league (manifest order), else the configured one."""
    spark = manifests.sparkSession
    cands = (in_flight(manifests)
             .select("league", (F.col("league") == configured).alias("is_cfg"), "pos")
             .orderBy(F.desc("is_cfg"), F.asc("pos")).limit(1))
    cfg = spark.range(1).select(F.lit(configured).alias("fallback"))
    return cfg.join(cands, how="left").select(F.coalesce("league", "fallback").alias("league"))


def foreign_schema(manifests: DataFrame, version: int = SCHEMA_VERSION) -> DataFrame:
    """In-flight manifests written by another schema version (discard);
    published foreign ones are left alone."""
    return in_flight(manifests).where(~F.col("schemaVersion").eqNullSafe(F.lit(version)))


def aborted_checkpoints(manifests: DataFrame) -> DataFrame:
    """Leagues whose checkpoint is aborted (to clear)."""
    return manifests.where(F.col("phase") == "aborted")


# ------------------------------------------------------------ A11 / A12
def classify_inventory(inventory: DataFrame) -> DataFrame:
    """P18 + P19 + F19 over a listing: category, league, snapshot, kind."""
    league, snap = K.parse_any("key")
    return inventory.select("*", K.classify_key("key").alias("category"),
                            league.alias("league"), snap.alias("snapshot_id"),
                            K.content_kind("key").alias("content_type"))


def usage_by_category(classified: DataFrame) -> DataFrame:
    """Bytes and objects per category, zero-filled over all 15."""
    spark = classified.sparkSession
    cats = spark.createDataFrame([(c,) for c in K.CATEGORIES], "category string")
    used = classified.groupBy("category").agg(F.sum("size").alias("bytes"),
                                              F.count(F.lit(1)).alias("objects"))
    return (cats.join(used, "category", "left")
            .select("category", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
                    F.coalesce("objects", F.lit(0)).cast("long").alias("objects")))


def snapshot_keys(classified: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The keys behind the groups of ``snapshots`` (league,
    snapshot_id[, category]): what a sweep or trim plan deletes. One row per
    key, so no list of a big snapshot is ever gathered."""
    on = [c for c in ("league", "snapshot_id", "category") if c in snapshots.columns]
    return (classified.where(F.col("snapshot_id").isNotNull())
            .join(snapshots.select(*on).distinct(), on, "left_semi").select("league", "snapshot_id", "category", "key", "size"))


def group_by_snapshot(classified: DataFrame) -> DataFrame:
    """Objects and bytes per (league, snapshot, category); their keys
    are ``snapshot_keys``."""
    return (classified.where(F.col("snapshot_id").isNotNull())
            .groupBy("league", "snapshot_id", "category")
            .agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes")))


# ------------------------------------------------------------ J5 / J11 / J12
def orphans(classified: DataFrame, manifests: DataFrame) -> DataFrame:
    """Transient objects (raw, chunk, snapshot-state, worker-result)
    whose snapshot is not in flight. Anti join on (league, snapshot)."""
    live = in_flight(manifests).select(F.col("league"), F.col("snapshotId").alias("snapshot_id")).distinct()
    transient = classified.where(F.col("category").isin(*K.TRANSIENT))
    return transient.join(live, ["league", "snapshot_id"], "left_anti")


def discard_plan(classified: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Every key of the given snapshots under the four snapshot
    prefixes (detail/agg/meta, raw, chunks, results) plus the state file."""
    targets = snapshots.select("league", "snapshot_id").distinct()
    scoped = classified.where(F.col("category").isin("detail", "agg", "meta", *K.TRANSIENT))
    league, snap = (F.regexp_extract("key", r"^snapshots/([^/]+)/([^/]+)/", 1),
                    F.regexp_extract("key", r"^snapshots/([^/]+)/([^/]+)/", 2))
    scoped = scoped.withColumn("league", F.coalesce(F.col("league"),
                                                    F.when(league != "", K.decode_segment(league))))
    scoped = scoped.withColumn("snapshot_id", F.coalesce(F.col("snapshot_id"), F.when(snap != "", snap)))
    return scoped.join(targets, ["league", "snapshot_id"], "left_semi")


def discard(classified: DataFrame, snapshots: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J11 whole: (keys to delete, catalogue without the discarded rows)."""
    return discard_plan(classified, snapshots), catalogue_remove(catalogue, snapshots)


def legacy_sweep_plan(classified: DataFrame, manifests: DataFrame) -> DataFrame:
    """Legacy chunk and raw keys: doomed (not in flight) vs protected
    (in flight), with objects and bytes per category."""
    legacy = classified.where(F.col("category").isin("chunk", "raw"))
    live = in_flight(manifests).select("league", F.col("snapshotId").alias("snapshot_id")) \
        .distinct().withColumn("__live", F.lit(True))
    marked = legacy.join(live, ["league", "snapshot_id"], "left")
    status = F.when(F.col("__live"), "protected").otherwise("doomed")
    return (marked.groupBy("category", status.alias("status"))
            .agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes")))


# ------------------------------------------------------------ J6 / W3 / W4
NEG_INF = float("-inf")


def snapshot_age(details: DataFrame, meta: DataFrame) -> DataFrame:
    """Age of each detail snapshot = completedAt ?? updatedAt of its
    meta; missing or unparsable meta -> -inf (treated as oldest)."""
    m = meta.select("league", "snapshot_id", "completedAt", "updatedAt")
    j = details.join(m, ["league", "snapshot_id"], "left")
    ms = _epoch_ms(F.coalesce(F.col("completedAt"), F.col("updatedAt"))).cast("double")
    return j.withColumn("age_ms", F.coalesce(ms, F.lit(NEG_INF))).drop("completedAt", "updatedAt")


def protect_newest(df: DataFrame, n: int, by: str = "league") -> DataFrame:
    """The newest ``n`` snapshots per league are never trimmed. Each
    task keeps ``n`` rows of a league before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.desc("age_ms"), F.asc("snapshot_id"))
    newest = df.select(by, "snapshot_id", "age_ms").withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n)
    return (df.join(newest.select(by, "snapshot_id", F.lit(True).alias("protected")), [by, "snapshot_id"], "left")
            .withColumn("protected", F.coalesce("protected", F.lit(False))))


def trim_plan(snapshots: DataFrame, total_bytes: Column, budget: Column) -> DataFrame:
    """Oldest first across leagues (ties by league, snapshot), whole
    snapshots, trimming while the running total is above budget (checked
    before each trim). The total runs over range partitions."""
    cands = snapshots.where(~F.col("protected"))
    summed = with_running_total(cands, ["age_ms", "league", "snapshot_id"], "bytes", "__before")
    planned = summed.withColumn("trimmed", (total_bytes - F.col("__before")) > budget).drop("__before")
    kept = snapshots.where(F.col("protected")).withColumn("trimmed", F.lit(False))
    return planned.unionByName(kept)


# ------------------------------------------------------------ J10
def catalogue_upsert(catalogue: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace own (league, snapshot) rows; foreign-schema rows and
    everything else are kept verbatim."""
    keep = catalogue.join(rows.select("league", "snapshot_id"), ["league", "snapshot_id"], "left_anti")
    return keep.unionByName(rows, allowMissingColumns=True)


def catalogue_remove(catalogue: DataFrame, targets: DataFrame) -> DataFrame:
    """Drop rows for the given snapshots (emptied leagues vanish)."""
    return catalogue.join(targets.select("league", "snapshot_id"), ["league", "snapshot_id"], "left_anti")


def mark_trimmed(catalogue: DataFrame, trimmed: DataFrame) -> DataFrame:
    """hasDetail = false for trimmed snapshots (idempotent)."""
    t = trimmed.select("league", "snapshot_id").distinct().withColumn("__t", F.lit(True))
    j = catalogue.join(t, ["league", "snapshot_id"], "left")
    return j.withColumn("hasDetail", F.when(F.col("__t"), F.lit(False)).otherwise(F.col("hasDetail"))) \
        .drop("__t")


# ------------------------------------------------------------ O4 / A17
def order_catalogue(catalogue: DataFrame) -> DataFrame:
    """Newest first by ladderCapturedAt, leagues A-Z in locale order,
    the freshly written row first on ties; ``position`` numbers the result
    over range partitions."""
    return with_global_ordinal(catalogue, [F.desc("ladderCapturedAt"), F.collate("league", "UNICODE").asc(), F.desc("is_new"),
                                           F.asc("snapshot_id")], "position")


def observed_write(df: DataFrame, path: str, name: str, **counters: Column) -> dict:
    """Write ``df`` (Parquet) while collecting run counters (``rows`` and
    the given aggregates) with ``observe`` in the same pass; returns the
    metrics (a few numbers)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()]).write.mode("errorifexists").parquet(path)
    return obs.get


def retention_plan(classified: DataFrame, manifests: DataFrame, meta: DataFrame,
                   keep_newest: int, budget_fraction: float | None = None,
                   budget_bytes: int | None = None) -> DataFrame:
    """J5 + J6 + W3 + W4 in one pass over the listing: the objects are
    aggregated once per (category, league, snapshot); the grand total, the
    bytes swept as orphans and each detail snapshot's size are read off
    that small table (one scan, one shuffle reused by every branch). The
    budget is absolute (``budget_bytes``) or a fraction of the post-sweep
    total."""
    # One row per (category, league, snapshot): tiny next to the listing.
    # Checkpointed (shared checkpoint folder) so the three branches below
    # read it instead of each re-scanning the listing.
    ensure_checkpoint_dir(classified.sparkSession)
    groups = classified.groupBy("category", "league", "snapshot_id").agg(
        F.sum("size").alias("bytes")).checkpoint(eager=True)
    live = in_flight(manifests).select("league", F.col("snapshotId").alias("snapshot_id")).distinct()
    swept = (groups.where(F.col("category").isin(*K.TRANSIENT))
             .join(live, ["league", "snapshot_id"], "left_anti"))
    total = groups.agg(F.sum("bytes").alias("__all")).crossJoin(
        swept.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("__swept"))) \
        .select((F.col("__all") - F.col("__swept")).alias("__total"))
    details = (groups.where(F.col("category") == "detail")
               .groupBy("league", "snapshot_id").agg(F.sum("bytes").alias("bytes")))
    aged_ = protect_newest(snapshot_age(details, meta), keep_newest)
    with_total = aged_.crossJoin(F.broadcast(total))  # one row
    budget = (F.lit(budget_bytes) if budget_bytes is not None
              else F.col("__total") * F.lit(float(budget_fraction)))
    return trim_plan(with_total, F.col("__total"), budget).drop("__total")
