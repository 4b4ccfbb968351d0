"""The operators' queries on the smallest tables: against their SQL twins, or against brute force."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracle  # noqa: E402
import test_fingerprints  # noqa: E402
import test_near_dedup  # noqa: E402
import test_repeats  # noqa: E402
from ledgerloom.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_twin(spark, name):
    with check_oracle.connect(SF) as connection:
        assert check_oracle.compare(spark, connection, name, SF) is None


@pytest.mark.parametrize(("name", "expected"), [
    ("op1_near_dedup", test_near_dedup.expected), ("op4_repeats", test_repeats.expected), ("op6_fingerprints", test_fingerprints.expected),
])
def test_query_agrees_with_brute_force(spark, name, expected):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r)[:5] if name == "op4_repeats" else tuple(r) for r in QUERIES[name](spark, SF).collect()]
    if name == "op1_near_dedup":
        assert all(kept == (doc_id == component) for doc_id, _, component, kept in got)
        got = [r[:3] for r in got]
    assert sorted(got, key=repr) == expected(rows)
