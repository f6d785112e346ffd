"""Snapshot state files and worker result files.

State files are gzipped NDJSON, one line per identity. A single ``.gz`` file
is one Spark task (gzip is not splittable), so writers here emit many part
files; readers take a directory or a glob.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas


def scan_state(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict read. A corrupt line raises (FAILFAST), a truncated gzip
    raises (corrupt files are not ignored), blank lines are skipped."""
    return (spark.read.schema(schemas.STATE_LINE)
            .option("mode", "FAILFAST")
            .option("ignoreCorruptFiles", "false")
            .json(path))


def scan_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lenient read of many worker result files.

    A missing prefix gives an empty table; a truncated gzip keeps the lines
    read before the fault; inside a file, only the lines before its first
    undecodable line are kept. Adds ``file`` and ``seq``, a struct
    (split offset, line within the split) that orders a file's lines.
    """
    # StructType.add mutates in place: build new schemas, never touch the shared one.
    schema = T.StructType(list(schemas.STATE_LINE.fields)
                          + [T.StructField("_corrupt_record", schemas.S)])
    try:
        df = (spark.read.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("ignoreCorruptFiles", "true")
              .option("ignoreMissingFiles", "true")
              .json(path))
    except Exception as exc:  # PATH_NOT_FOUND: a missing prefix is an empty result
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        seq_t = T.StructType([T.StructField("block", schemas.L), T.StructField("line", schemas.L)])
        return spark.createDataFrame([], T.StructType(
            list(schemas.STATE_LINE.fields)
            + [T.StructField("file", schemas.S), T.StructField("seq", seq_t)]))
    # Line order within a file: (start offset of the split, index within the
    # split). A gzip file is one split; a large plain file may be several,
    # and their partitions are not in offset order, so the split offset leads.
    idx = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    df = (df.withColumn("file", F.col("_metadata.file_path"))
          .withColumn("seq", F.struct(F.col("_metadata.file_block_start").alias("block"),
                                      idx.alias("line"))))
    return keep_before_first_corrupt(df)


def keep_before_first_corrupt(df: DataFrame) -> DataFrame:
    """Drop each file's lines from its first corrupt line onwards
    (the first corrupt ``seq`` per file is a small aggregate)."""
    # A corrupt line has every data column NULL; naming ``account`` here
    # keeps the predicate equivalent while not querying the corrupt column alone.
    bad = F.col("_corrupt_record").isNotNull() & F.col("account").isNull()
    first_bad = df.where(bad).groupBy("file").agg(F.min("seq").alias("__bad"))
    kept = df.join(first_bad, "file", "left") \
        .where(F.col("__bad").isNull() | (F.col("seq") < F.col("__bad")))
    return kept.drop("__bad", "_corrupt_record")


def scan_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: the typed transform input (payloads as JSON text)."""
    return spark.read.schema(schemas.RAW_CHAR).option("mode", "FAILFAST").json(path)


def empty_chars(spark: SparkSession) -> DataFrame:
    """A typed empty transform input, so gates fail cleanly."""
    return spark.createDataFrame([], schemas.RAW_CHAR)


def write_state(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Write a state version as gzipped NDJSON part files under a new
    directory (never the directory being read); absent fields stay absent.
    Returns the path written; callers move their pointer afterwards."""
    out = df.repartition(partitions) if partitions else df
    (out.write.mode("errorifexists").option("compression", "gzip")
     .option("ignoreNullFields", "true").json(path))
    return path
