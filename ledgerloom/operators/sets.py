"""Identifier sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.clean import stripped


def identifiers(df: DataFrame, column: str, strip: bool = True) -> DataFrame:
    """Distinct non-null identifiers, without blanks around them."""
    value = stripped(F.col(column)) if strip else F.col(column)
    return df.select(value.alias("identifier")).where("identifier IS NOT NULL").distinct()


def dealt(df: DataFrame, column: str, parts: int | None) -> DataFrame:
    """The rows dealt by a column into a set number of parts, which Spark does not merge to fewer, larger ones.

    For the right side of a semi or anti join, which then has this number of parts or ``spark.sql.shuffle.partitions``;
    on the left side the join would be made before the dealing. The number must be above that setting: otherwise the join
    may take exchanges of its own, whose parts are merged.
    """
    return df if parts is None else df.repartition(parts, column)


def membership(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per identifier of either source with ``in_first`` and ``in_second``.

    A union and one grouping: a single shuffle answers both differences and the
    intersection, where three set operations would shuffle both sides three times.
    """
    return (
        first.select("identifier", F.lit(True).alias("in_first"), F.lit(False).alias("in_second"))
        .unionByName(
            second.select("identifier", F.lit(False).alias("in_first"), F.lit(True).alias("in_second"))
        )
        .groupBy("identifier")
        .agg(F.bool_or("in_first").alias("in_first"), F.bool_or("in_second").alias("in_second"))
    )


def only_in(first: DataFrame, second: DataFrame) -> DataFrame:
    """Identifiers of the first set that the second does not have."""
    return first.join(second, "identifier", "left_anti")


def in_both(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.join(second, "identifier", "left_semi")


def stacked(*parts: DataFrame) -> DataFrame:
    """Union of parts by column name; a part may lack columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
