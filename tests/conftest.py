import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Evaluate a column expression over a list of strings."""
    from pyspark.sql import functions as F

    def run(expression, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i INT, v STRING")
        return [r[0] for r in rows.select(expression(F.col("v")).alias("x"), "i").orderBy("i").collect()]

    return run
