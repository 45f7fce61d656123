import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g", app="threadloom-tests")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate a column expression on a list of strings, in order."""
    from pyspark.sql import functions as F

    def run(values, expression):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
        return [r[0] for r in rows.orderBy("i").select("i", expression(F.col("s")).alias("v")).orderBy("i").select("v").collect()]

    return run
