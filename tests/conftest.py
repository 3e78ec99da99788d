import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from larder.session import get_spark
    s = get_spark("larder-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def one(spark, expr_col, schema, rows):
    """Evaluate a Column over a literal frame and return the values."""
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_col).collect()]
