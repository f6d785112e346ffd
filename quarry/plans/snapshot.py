"""The snapshot transform flow (finalize -> merge -> normalise -> aggregate ->
gate -> publish), as composable stages over DataFrames.

``normalised(state, tree)`` returns the seven detail tables lazily; the
publish step (``quarry.sources.sinks.publish_snapshot``) persists the shared
intermediates (``chars`` and ``item_rows``) once, like the reference's
materialised tables, so the JSON is parsed a single time for all writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import aggregates as A
from quarry.operators import normalize as N
from quarry.operators.common import latest_per_key
from quarry.plans import adapters
from quarry.session import checkpoint_root, wide_documents
from quarry.sources.state import scan_state
from quarry.sources.tree import parse_tree_lines

# Fixed snapshot id used for the driver-table runs.
SNAPSHOT_ID = "2024-01-01T00-00-00-000Z"


@dataclass
class Normalised:
    chars: DataFrame          # deduped transform input + parsed payloads
    item_rows: DataFrame
    tree: DataFrame
    snapshot_id: str
    # The same input unparsed, of which a table parses the fields it reads.
    payloads: DataFrame | None = None
    # Set where ``item_rows`` has been written and is to be read instead.
    items_written: bool = False

    def items_with(self, fields: Sequence[str]) -> DataFrame:
        """The item rows, with these fields at least."""
        if self.payloads is None or self.items_written:
            return self.item_rows
        return N.item_rows(N.parse_payloads(self.payloads, ["items"], ["items"], fields))

    def parsed(self, items: Sequence[str], passives: Sequence[str]) -> DataFrame:
        """The characters, with these fields of their documents at least."""
        return self.chars if self.payloads is None else N.parse_payloads(self.payloads, items, passives)

    def table(self, name: str) -> DataFrame:
        if name == "characters":
            return N.characters(self.parsed(["character"], []), self.snapshot_id)
        if name == "items":
            return N.items(self.items_with(N.ITEMS_FIELDS))
        if name == "item_mods":
            return N.item_mods(self.items_with(N.MODS_FIELDS))
        if name == "skills":
            return N.skills(self.items_with(N.SKILLS_FIELDS))
        if name == "passives":
            return N.passives(self.parsed([], ["hashes", "hashes_ex", "jewel_data"]), self.tree)
        if name == "masteries":
            return N.masteries(self.parsed([], ["mastery_effects"]))
        if name == "raw":
            return N.raw(self.chars)
        raise KeyError(name)

    def aggregate(self, kind: str, source_table: DataFrame | None = None) -> DataFrame:
        """One aggregate kind; ``source_table`` lets the publish step read
        the already written detail table instead of recomputing it."""
        source, build = A.AGGREGATES[kind]
        counts = build(self.table(source) if source_table is None else source_table)
        total = self.chars.agg(F.count(F.lit(1)).alias("total"))
        return (counts.crossJoin(F.broadcast(total))
                .select(F.lit(kind).alias("kind"), "name", "count",
                        A.percentage_col("count", "total").alias("percentage"), "total"))


def normalise(state: DataFrame, tree: DataFrame, snapshot_id: str = SNAPSHOT_ID) -> Normalised:
    return of_characters(N.latest_per_identity(N.ok_records(state)), tree, snapshot_id)


def of_characters(latest: DataFrame, tree: DataFrame, snapshot_id: str = SNAPSHOT_ID) -> Normalised:
    """The transform over deduplicated characters (the output of W1)."""
    chars = N.parse_payloads(latest)
    return Normalised(chars=chars, item_rows=N.item_rows(chars), tree=tree, snapshot_id=snapshot_id, payloads=latest)


_STAGED: dict[tuple[str, str], str] = {}


def staged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state documents built from the driver's tables, in two steps done
    once per application under the shared checkpoint folder:

    1. written as gzipped NDJSON part files, the form the state file has in
       production;
    2. ingested once through the strict state scan (S1) into a Parquet
       working copy, which every job then reads: columnar, so a job that
       needs no payload (tallies, pending scans) never reads it, and no job
       re-parses the outer NDJSON.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        path = checkpoint_root(spark, "state-documents", unique=True)
        state = adapters.snapshot_state(spark, sf_dir)
        with wide_documents(spark):
            state.write.mode("errorifexists").option("compression", "gzip").json(f"{path}/ndjson")
        scan_state(spark, f"{path}/ndjson").write.mode("errorifexists") \
            .option("compression", "zstd").parquet(f"{path}/parquet")
        _STAGED[key] = f"{path}/parquet"
    return spark.read.schema(schemas.STATE_LINE).parquet(_STAGED[key])


_CHARACTERS: dict[tuple[str, str], str] = {}


def staged_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot's deduplicated ``ok`` lines (P1, W1), written once per
    application to the shared checkpoint folder: no query repeats the dedupe."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHARACTERS:
        path = checkpoint_root(spark, "characters", unique=True)
        latest = N.latest_per_identity(N.ok_records(staged_state(spark, sf_dir)), in_place=True)
        latest.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        _CHARACTERS[key] = path
    return spark.read.parquet(_CHARACTERS[key])


def identity_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state as production keeps it, one line per identity: its latest
    ``ok`` line, or without one its last line."""
    state = staged_state(spark, sf_dir).withColumn("__ok", F.col("outcome") == "ok")
    return latest_per_key(state, ["account", "character"], ["__ok", "fetchedAt", "ordinal"], row_id="ordinal").drop("__ok")


def claimed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a manifest claims: the identities of the tables, counted without the state."""
    orders, customer = (adapters.table(spark, sf_dir, t) for t in ("orders", "customer"))
    return (orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select("c_name", "o_orderpriority").distinct()
            .agg(F.count(F.lit(1)).alias("total_characters")))


_INVENTORY: dict[tuple[str, str], str] = {}


def staged_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object listing as an inventory table, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INVENTORY:
        path = checkpoint_root(spark, "inventory", unique=True)
        adapters.object_inventory(spark, sf_dir).write.mode("errorifexists").parquet(path)
        _INVENTORY[key] = path
    return spark.read.parquet(_INVENTORY[key])


def from_tables(spark: SparkSession, sf_dir: str) -> Normalised:
    """The transform over documents built from the driver's tables."""
    tree = parse_tree_lines(adapters.tree_lines(spark, sf_dir))
    return of_characters(staged_characters(spark, sf_dir), tree)
