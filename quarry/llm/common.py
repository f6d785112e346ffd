"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_root

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``.
WORD_RE = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that Spark packs into an Arrow batch; 10,000 documents, its bound by rows, are tens of MB on both sides.
BATCH_BYTES = 4_000_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so that
    their Python workers can import it wherever they run, and bound the batches
    that they get by bytes."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="quarry-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return checkpoint_root(spark, f"llm-{name}", unique=True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage, and a lost executor re-reads the files."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of ids and numbers up to which a table is broadcast (some 100 MB in memory).
BROADCAST_ROWS = 2_000_000


def small_side(side: DataFrame, counted: DataFrame) -> DataFrame:
    """``side`` with a broadcast hint if ``counted``, a written table of as
    many narrow rows, is within the bound; beyond it the join shuffles."""
    return F.broadcast(side) if counted.count() <= BROADCAST_ROWS else side


def planned_parts(df: DataFrame, each: int = 8_000_000) -> int:
    """How many parts of about ``each`` bytes ``df`` makes, by the optimizer's
    size estimate (file sizes for a scan; runs no job), and no fewer than
    ``spark.sql.shuffle.partitions``, which alone decides where the size is
    unknown. It only says how the work is cut, never what is computed."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return least if size >= 1 << 60 else max(least, size // each + 1)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, chars: int,
                rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``chars`` bytes of text (a longer
    text is a slice of its own) and at most ``rows`` rows, so a worker's
    memory does not depend on how many rows Spark packs into a batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > chars or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
