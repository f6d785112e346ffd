"""What Spark hands to the operators' Python workers."""

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.common import BATCH_BYTES


def test_batches_are_bounded_by_bytes(spark):
    rows = spark.range(0, 3_000, 1, 1).select(F.expr("repeat(cast(id % 10 as string), 4096)").alias("text"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": batch.num_rows, "size": batch.nbytes}])

    got = rows.mapInArrow(run, "n long, size long").collect()
    assert sum(r.n for r in got) == 3_000
    assert max(r.size for r in got) < 1.1 * BATCH_BYTES
