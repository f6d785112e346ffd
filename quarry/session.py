"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so ISO-8601 rendering is stable, AQE so
# shuffle partition counts and join strategies adapt to runtime sizes.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quarry",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists.

    ``driver_memory`` only takes effect when this call starts the JVM; in
    local mode the driver heap is the executors' memory too."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder every executor can reach,
    and its absence is an error: a machine-local folder would scatter the
    staged tables. Only a session whose executors are threads of the driver
    (``local[...]``) falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = os.path.join(os.environ.get("TMPDIR", "/tmp"), "quarry-checkpoints")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def checkpoint_root(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (for staged tables/streams)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if unique:
        parts = parts + (uuid.uuid4().hex,)
    return "/".join((root,) + tuple(p.strip("/") for p in parts))


@contextmanager
def wide_documents(spark: SparkSession) -> Iterator[None]:
    """For actions inside that pack rows into wide documents.

    Collected lists are grouped over sorted rows, one group at a time: the
    hashed form sorts its wide buffers a second time from 128 groups on and
    spills them. Generated methods beyond the 8,000 bytes that the JVM compiles
    are left to the operator-wise code, which is split into small ones."""
    wanted = {"spark.sql.execution.useObjectHashAggregateExec": "false", "spark.sql.codegen.hugeMethodLimit": "8000"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors, once per application, for
    operators that run Python there."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="quarry-")) / f"{package.name}-code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark
