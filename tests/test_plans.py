"""What the plans must look like, at any scale."""

import re

import pytest

from ledgerloom.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_plan(spark, name):
    """No Python, no products, no scan of all columns, and one-task work only on little data."""
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    for scanned in re.findall(r"FileScan parquet \[([^\]]*)\]", plan):
        columns = scanned.split(",")
        if columns[0].startswith("l_"):
            assert len(columns) < 10
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # a partial aggregate or a limit comes before it
            below = lines[i + 1] if "Project" not in lines[i + 1] else lines[i + 2]
            assert re.search(r"Aggregate|Limit|TakeOrdered", below), below


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["title_coalesce_left"](spark, SF))
    assert "GreaterThan(o_totalprice,250000.0)" in plan
    # the second source reads whole tables
    assert "LessThan(o_orderdate" not in plan_of(QUERIES["second_source_dataset"](spark, SF))


def test_code_lists_are_broadcast(spark):
    plan = plan_of(QUERIES["ordered_distinct_codes"](spark, SF))
    assert plan.count("LocalTableScan") == 2 and "SortMergeJoin" not in plan


def test_first_rows_are_picked_before_the_shuffle(spark):
    plan = plan_of(QUERIES["dedup_first"](spark, SF))
    assert re.search(r"Exchange hashpartitioning[\s\S]*WindowGroupLimit .*Partial", plan)


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("budget_agg", "flow_and_finance_lists", "trans_weighted_conditional", "year_gap"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "partial_sum" in plan or "partial_min" in plan


def test_top_n_is_not_a_full_sort(spark):
    for name in ("top10_spot", "shared_top20_gap", "page_offset", "donor_top4_autres"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF))


def test_large_tables_without_statistics_are_not_broadcast(spark):
    """With broadcasts off by size, only the fixed code lists and the top rows are broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("activity_star", "top10_spot", "shared_top20_gap", "exclusive_value", "trade_facts", "registry_status"):
            lines = plan_of(QUERIES[name](spark, SF)).splitlines()
            for i, line in enumerate(lines):
                if "BroadcastExchange" in line:
                    below = "\n".join(lines[i + 1:i + 6])
                    assert re.search(r"LocalTableScan|TakeOrderedAndProject", below), f"{name}: {below}"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name,prefix,scans", [
    ("donor_top4_autres", "l_", 1), ("donor_top4_autres", "o_", 2),
    ("top10_spot", "l_", 2), ("shared_top20_gap", "l_", 2),
])
def test_a_table_is_not_scanned_again(spark, name, prefix, scans):
    """Executed plan: the second use of a common part is a reused exchange."""
    df = QUERIES[name](spark, SF)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [" + prefix) == scans


def test_landed_star_has_more_buckets_for_more_input(spark, tmp_path, monkeypatch):
    from ledgerloom import landing
    from ledgerloom.queries import standins
    from ledgerloom.queries.registry import QUERIES

    for name, schema in standins.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made, real = set(), landing.write_in_buckets
    monkeypatch.setattr(landing, "write_in_buckets", lambda df, path, key, order, n: made.add(n) or real(df, path, key, order, n))
    assert QUERIES["landed_star"](spark, str(tmp_path)).count() == 0
    assert made == {12}
    monkeypatch.setattr(landing, "BUCKET_BYTES", 100)
    made.clear()
    assert QUERIES["landed_star"](spark, str(tmp_path)).count() == 0
    assert len(made) == 1 and made.pop() > 12
