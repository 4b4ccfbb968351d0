import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", shuffle_partitions=4, driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Column expressions evaluated over rows of one column ``x`` (and ``y``, ``z``)."""
    def run(schema, rows, *columns):
        df = spark.createDataFrame(rows, schema)
        return [tuple(r) for r in df.select(*columns).collect()]
    return run
