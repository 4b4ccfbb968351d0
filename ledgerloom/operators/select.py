"""Projections over the columns that exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.rank import positioned
from ledgerloom.session import written


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent names are fine."""
    return df.drop(*names)


def in_order(df: DataFrame, names: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[name for name in names if name in df.columns])


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """The same value in every row; a value may be an expression, such as the day of the run."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def run_date() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def page(df: DataFrame, order: list[Column], size: int, number: int) -> DataFrame:
    """One page of a total order, for users who ask for one; reads never page."""
    return df.orderBy(*order).offset(size * number).limit(size)


class Pages:
    """Pages of a total order for users who browse: sorted and numbered once, each page read by its range.

    Rows are written in order with their ``position``, so the statistics of files and row groups lead to those of a page
    and the rest is skipped. ``folder`` keeps them for later sessions; without one they go to the shared folder.
    """

    def __init__(self, df: DataFrame, order: list[Column | str], size: int, folder: str | None = None) -> None:
        self.size = size
        rows = positioned(df, order)
        if folder:
            rows.write.mode("overwrite").parquet(folder)
            self.rows = df.sparkSession.read.schema(rows.schema).parquet(folder)
        else:
            self.rows = written(rows, "pages")

    def page(self, number: int) -> DataFrame:
        """The rows of a page, from 0; their ``position`` gives their order."""
        first = self.size * number
        return self.rows.where((F.col("position") > first) & (F.col("position") <= first + self.size))

    def firsts(self) -> DataFrame:
        """The first row of each page: what a user jumps by."""
        return self.rows.where((F.col("position") - 1) % self.size == 0).withColumn(
            "page", ((F.col("position") - 1) / self.size).cast("long")
        )
