"""Grouping operators.

All of them combine on the map side, so one key with a third of the rows reaches the
shuffle as at most one row per map task and distinct code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.dims import lookup
from ledgerloom.operators.quantiles import exact_median
from ledgerloom.session import cut


def total(c: Column) -> Column:
    """Sum in which nothing adds up to 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def total_where(condition: Column, c: Column) -> Column:
    return total(F.when(condition, c).otherwise(0.0))


def grouped(df: DataFrame, keys: list[str], *measures: Column, null_keys: bool = False) -> DataFrame:
    """Group by the keys; rows with a null key are left out unless ``null_keys``."""
    if not null_keys:
        for key in keys:
            df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(*measures)


def ordered_lists(
    df: DataFrame,
    key: str,
    order: str,
    codes: list[str],
    labels: dict[str, tuple[str, DataFrame]] | None = None,
    sums: dict[str, Column] | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Distinct codes per key in order of first appearance, as ``array<string>``.

    ``labels`` maps an output name to ``(code column, dim)``: codes become labels before
    the distinct, unknown codes stay. ``sums`` are added up in the same pass.

    Two steps: the first appearance of every code combination is found with a hash
    aggregate, and only those combinations are collected. A list is therefore as long as
    the published cell, however many rows repeat its codes. The combinations move to their key as plain rows and are
    collected there; ``in_place`` is for tables in buckets of the key, which need not move.
    """
    labels, sums = labels or {}, sums or {}
    first = df.groupBy(key, *codes).agg(
        F.min(order).alias("_first"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    for out, (code, dim) in labels.items():
        first = lookup(first, dim, F.col(code).cast("string"), out, F.col(code).cast("string"))
    names = list(codes) + list(labels)
    collected = (first if in_place else first.repartition(key)).groupBy(key).agg(
        F.sort_array(
            F.collect_list(F.struct("_first", *[F.col(n).cast("string").alias(n) for n in names]))
        ).alias("_items"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
    )
    # array_except drops the null and keeps the first of equal elements, without a lambda
    nothing = F.array(F.lit(None).cast("string"))
    lists = [F.array_except(F.col(f"_items.{n}"), nothing).alias(n) for n in names]
    return collected.select(key, *lists, *sums)


def joined_text(items: Column | str) -> Column:
    """``a, b, c`` of a list; an empty list is an empty text."""
    return F.array_join(items, ", ")


def top_and_others(
    df: DataFrame,
    key: str,
    measures: list[str],
    by: str,
    n: int,
    others: str,
) -> DataFrame:
    """The n largest rows and one row that adds up all the rest.

    The row of the rest always exists and is marked by ``is_others``, so that a real
    member of that name stays apart from it. ``position`` gives the published order.

    The largest rows carry all measures, and the final sums
    take theirs from there; their limit tells the optimizer how few they are. Both uses of ``df`` then need the same columns, and Spark
    computes it once and reuses the exchange.
    """
    order = [F.col(by).desc_nulls_last(), F.col(key).asc_nulls_last()]
    top = df.orderBy(*order).limit(n).select(
        F.row_number().over(Window.orderBy(*order)).alias("position"),  # over n rows
        F.col(key).alias("_top"), *[F.col(m).alias(f"_top_{m}") for m in measures],
    )
    marked = df.join(top, F.col(key).eqNullSafe(F.col("_top")), "left")
    in_top = F.col("position").isNotNull()
    parts = marked.select(
        F.coalesce("position", F.lit(n + 1)).alias("position"),
        (~in_top).alias("is_others"),
        F.when(in_top, F.col(key)).otherwise(others).alias(key),
        *[F.when(in_top, F.col(f"_top_{m}")).otherwise(F.col(m)).alias(m) for m in measures],
    )
    nothing = df.sparkSession.range(1).select(
        F.lit(n + 1).alias("position"), F.lit(True).alias("is_others"), F.lit(others).alias(key),
        *[F.lit(0).cast(df.schema[m].dataType).alias(m) for m in measures],
    )
    return parts.unionByName(nothing).groupBy("position", "is_others", key).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )


def gap_spread(df: DataFrame, percent: str) -> DataFrame:
    """Count, sample deviation and exact median of the gaps that exist.

    The gaps are written once, since the median reads them several times.
    """
    gaps = cut(df.select(F.col(percent).cast("double").alias("gap")).where("gap IS NOT NULL"))
    median = exact_median(gaps, "gap")
    return gaps.agg(
        F.count("gap").alias("n_gaps"),
        F.stddev_samp("gap").alias("spread"),
        F.lit(median).cast("double").alias("median_gap"),
    )


def long_form(row: DataFrame, metrics: Iterable[tuple[str, Column]]) -> DataFrame:
    """A one-row DataFrame as ``(position, metric, value)`` rows, values as text."""
    items = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric"), c.cast("string").alias("value"))
        for i, (name, c) in enumerate(metrics, 1)
    ]
    return row.select(F.inline(F.array(*items)))
