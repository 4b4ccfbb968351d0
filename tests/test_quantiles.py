"""Exact medians by counting, and places in a global order."""

import statistics

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import gap_spread
from ledgerloom.operators.quantiles import exact_median, value_at_rank
from ledgerloom.operators.rank import positioned, with_running_total


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "gap double").repartition(3)


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 1.0], [3.0, 1.0, 2.0], [1.0, 1.0, 1.0, 5.0], [1.0, 1.0, 5.0, 5.0], [-0.5, 0.0, 7.25, 7.25, 1e300, -1e300],
    [float(i * 7919 % 1009) for i in range(1008)], [5.0] * 400 + [float(i) for i in range(801)],
])
def test_median(spark, values):
    assert exact_median(numbers(spark, values + [None]), "gap") == statistics.median(values)


def test_median_of_nothing(spark):
    assert exact_median(numbers(spark, []), "gap") is None
    assert exact_median(numbers(spark, [None, None]), "gap") is None
    row = gap_spread(numbers(spark, [None]), "gap").first()
    assert (row["n_gaps"], row["spread"], row["median_gap"]) == (0, None, None)


def test_median_of_many_values_takes_several_rounds(spark):
    df = spark.range(200_001).select(((F.col("id") * 7919) % 200_001 * 0.25).alias("gap"))
    assert exact_median(df, "gap") == 25_000.0
    doubled = df.unionByName(df.where("gap < 1000"))  # even or odd, ties
    values = sorted(r[0] for r in doubled.collect())
    assert exact_median(doubled, "gap") == statistics.median(values)


def test_every_rank(spark):
    values = [3.0, 1.0, 1.0, 2.0, 9.0, 1.0]
    df = numbers(spark, values)
    assert [value_at_rank(df, "gap", i) for i in range(6)] == sorted(values)
    with pytest.raises(IndexError):
        value_at_rank(df, "gap", 6)


def test_a_hot_value_is_no_state(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 4.0).otherwise(F.col("id") * 1e-4).alias("gap"))
    values = [4.0 if i % 3 == 0 else i * 1e-4 for i in range(300_000)]
    assert exact_median(df, "gap") == pytest.approx(statistics.median(values), abs=0)


def test_plan_of_the_spread_has_no_median(spark):
    plan = gap_spread(numbers(spark, [1.0, 2.0]), "gap")._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "median(" not in plan


def test_positions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("key"), F.lit("x").alias("_row")).repartition(7)
    placed = positioned(df, [F.col("key").desc()])
    assert placed.columns == ["position", "key", "_row"]
    assert sorted((r[0], r[1]) for r in placed.collect()) == [(i + 1, 4999 - i) for i in range(5000)]
    assert positioned(df.where("false"), ["key"]).collect() == []


def test_no_task_sees_all_rows_of_a_sort(spark):
    df = spark.range(20_000).withColumn("hot", F.lit(1)).repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = positioned(df, ["hot", "id"])
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 10_000


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("key"), F.lit(2).alias("n")).repartition(5)
    got = with_running_total(df, ["key"], "n", "total").collect()
    assert sorted((r["key"], r["total"]) for r in got) == [(i, 2 * (i + 1)) for i in range(1000)]
