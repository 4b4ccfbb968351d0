"""First row per key, largest rows, places in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import cut


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one candidate row per key and map task before the shuffle
    (``WindowGroupLimit``), so a key with very many copies does not travel whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def largest(df: DataFrame, n: int, measure: str, *tie_break: Column | str) -> DataFrame:
    """The n rows with the largest measure, nulls last: a distributed top-n, not a sort."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie_break).limit(n)


# ------------------------------------------------------------------ global order

def _sorted_parts(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows sorted by a range shuffle, with the number of their part (``_part``) and their row in it (``_row``, from 0).

    The rows are written once: parts come from sampled bounds, so they must not be dealt out a second time.
    """
    numbered = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    row = F.col("_at").bitwiseAND((1 << 33) - 1)  # Spark numbers rows of a part in the lower 33 bits
    return numbered.withColumns({"_part": F.shiftright("_at", 33), "_row": row}).drop("_at")


def _offsets(parts: DataFrame, amount: Column) -> DataFrame:
    """``_part, _before``: the sum over all earlier parts; one row per part of a sort, so one small window."""
    sums = parts.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select(F.col("_part").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))


def positioned(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Rows with their place in a global order, from 1, as first column.

    A range sort deals the rows out, each part numbers its own, and the counts of the parts before are added: no
    task sees all rows. ``order`` should tell all rows apart; equal ones are numbered as they come.
    """
    parts = _sorted_parts(df, order)
    placed = parts.join(F.broadcast(_offsets(parts, F.lit(1))), F.col("_part") == F.col("_of"))
    return placed.select((F.col("_before") + F.col("_row") + 1).alias(name), *[F.col(f"`{c}`") for c in df.columns])


def with_running_total(df: DataFrame, order: list[Column | str], amount: str, name: str) -> DataFrame:
    """Rows with the sum of an amount over all rows up to them in a global order.

    As :func:`positioned`: totals inside the parts of a range sort, and the sums of the parts before.
    """
    parts = _sorted_parts(df, order)
    inside = F.sum(amount).over(Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0))
    totals = parts.withColumn("_inside", inside)
    placed = totals.join(F.broadcast(_offsets(parts, F.col(amount))), F.col("_part") == F.col("_of"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_inside")).alias(name))
