import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def spark():
    from quarry.llm.common import ship
    from quarry.session import get_spark

    s = get_spark("local[4]", app="quarry-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return ship(s)


@pytest.fixture
def frame(spark):
    """frame(ddl, rows): a DataFrame; further columns with clashing names are added."""
    from pyspark.sql import functions as F

    def make(ddl, rows, clashing=("kept", "n", "size", "row", "token", "node", "h", "s", "k", "component", "flag", "score", "batch")):
        df = spark.createDataFrame(rows, ddl)
        return df.withColumns({c: F.lit("x") for c in clashing if c not in df.columns})
    return make
