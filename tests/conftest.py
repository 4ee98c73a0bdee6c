import os
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textmill.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of `build(*columns)` on a one-row table."""

    def run(build, schema="text string", *values):
        expression = build(*[F.col(c) for c in StructType.fromDDL(schema).names])
        return spark.createDataFrame([values], schema).select(expression.alias("x")).first()["x"]

    return run
