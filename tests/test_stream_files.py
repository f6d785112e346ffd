"""Staged stream files: bounded rows a file, whatever the table's size, in as many batches as before."""

from quarry.session import checkpoint_root
from quarry.streaming import incremental as SM


def test_large_tables_are_cut_into_more_files(spark):
    rows = spark.range(100).withColumnRenamed("id", "seq")
    few = SM.stage_files(rows, checkpoint_root(spark, "stage-test", unique=True), 2, ["seq"])
    assert len(spark.read.parquet(few).inputFiles()) == 2 and SM.files_a_batch(spark, few, 2) == 1
    many = SM.stage_files(rows, checkpoint_root(spark, "stage-test", unique=True), 2, ["seq"], rows=10)
    each = SM.files_a_batch(spark, many, 2)
    assert len(spark.read.parquet(many).inputFiles()) > 4 and each > 2
    assert sorted(r.seq for r in spark.read.parquet(many).collect()) == list(range(100))
    batches = []
    stream = spark.readStream.schema("seq long").option("maxFilesPerTrigger", each).parquet(many)
    q = (stream.writeStream.foreachBatch(lambda df, _: batches.append(df.count()))
         .option("checkpointLocation", checkpoint_root(spark, "stage-test", unique=True)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(batches) == 2 and sum(batches) == 100
