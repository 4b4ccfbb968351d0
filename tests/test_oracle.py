"""Every registered query against its SQL twin at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402
from __spark_entry__ import entry, oracle_sql  # noqa: E402
from ledgerloom.queries.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with check_oracle.connect(SF) as c:
        yield c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_twin(spark, connection, name):
    assert name in oracle_sql()
    assert check_oracle.compare(spark, connection, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() == 5
