"""Exact values by rank, by counting in ranges: no task and no state holds all values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A bracket around the rank sought is this part of the rows wide on either side; sketches are ten times as fine.
MARGIN = 1e-3


def value_at_rank(values: DataFrame, column: str, rank: int) -> object:
    """The value with ``rank`` smaller or equal ones before it (from 0) among those that are not null.

    Rounds of two passes. A mergeable quantile sketch of bounded size proposes a bracket around the rank, and the rows
    below, on and between its ends are counted exactly. The counts say where the rank lies, whatever the sketch
    said: on an end, which is the answer, or in one of the three ranges, in which the next round goes on.
    A round leaves some thousandths of the rows; an end that a third of all rows share is found at once.
    """
    value: Column = F.col(column)
    rows = values.where(value.isNotNull())
    while True:
        n = rows.count()
        if not 0 <= rank < n:
            raise IndexError(f"rank {rank} of {n} values")
        shares = [max(rank / n - MARGIN, 0.0), min((rank + 1) / n + MARGIN, 1.0)]
        low, high = rows.agg(
            F.percentile_approx(column, [float(s) for s in shares], int(10 / MARGIN)).alias("ends")
        ).first()["ends"]
        low, high = F.lit(low), F.lit(high)
        c = rows.agg(
            F.count_if(value < low).alias("below"), F.count_if(value <= low).alias("to_low"),
            F.count_if(value < high).alias("before_high"), F.count_if(value <= high).alias("to_high"),
            F.any_value(low).alias("low"), F.any_value(high).alias("high"),
        ).first()
        if rank < c["below"]:
            rows = rows.where(value < low)
        elif rank < c["to_low"]:
            return c["low"]
        elif rank < c["before_high"]:
            rows, rank = rows.where((value > low) & (value < high)), rank - c["to_low"]
        elif rank < c["to_high"]:
            return c["high"]
        else:
            rows, rank = rows.where(value > high), rank - c["to_high"]


def exact_median(df: DataFrame, column: str) -> float | None:
    """The middle value, or the mean of the two middle ones; None without values.

    ``df`` is read in every round: hand in written rows.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    n = values.count()
    if not n:
        return None
    low = value_at_rank(values, "v", (n - 1) // 2)
    if n % 2:
        return low
    reached = values.where(F.col("v") <= F.lit(low)).count()
    high = low if reached > n // 2 else values.where(F.col("v") > F.lit(low)).agg(F.min("v")).first()[0]
    return 0.5 * low + 0.5 * high
