"""Lists of distinct values in order of first appearance, as rows and as cells of text.

No array grows with the rows of a key: rows are numbered by a range sort, and a cell is put together from pieces of
bounded length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.rank import positioned

#: Values in one piece of a cell.
PIECE = 1024


def numbered(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """``key, position, columns``: distinct combinations of each key, numbered from 1 in order of first appearance.

    Two levels: the place in a global sort by key and first appearance, whose ranges are numbered each on their own and
    offset by the counts of the ranges before, less the place of the key's first combination. A key with a third of all
    rows is spread over many ranges.
    """
    first = df.groupBy(key, *columns).agg(F.min(order).alias("_first"))
    placed = positioned(first, [key, "_first", *columns], "_place")
    starts = placed.groupBy(F.col(key).alias("_of")).agg(F.min("_place").alias("_start"))
    return placed.join(starts, F.col(key).eqNullSafe(F.col("_of"))).select(
        key, (F.col("_place") - F.col("_start") + 1).alias("position"), *columns
    )


def cells(rows: DataFrame, key: str, columns: list[str], separator: str = ", ") -> DataFrame:
    """One row per key with each column's distinct values as text, in order of ``position``; nulls are left out.

    Values are joined to pieces of :data:`PIECE` positions, and pieces to the cell: arrays hold a thousand values, or a
    thousandth of them. A key without a value has an empty text.
    """
    items = F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)
    ])
    values = rows.select(key, "position", F.explode(items).alias("_item")).groupBy(
        key, F.col("_item.column").alias("column"), F.col("_item.value").alias("value")
    ).agg(F.min("position").alias("position"))
    known = F.when(F.col("value").isNotNull(), F.struct("position", "value"))
    pieces = values.groupBy(key, "column", F.floor((F.col("position") - 1) / PIECE).alias("piece")).agg(
        F.sort_array(F.collect_list(known)).alias("items")
    )
    text = F.when(F.size("items") > 0, F.struct("piece", F.array_join("items.value", separator).alias("text")))
    joined = pieces.select(key, "column", text.alias("text")).groupBy(key).agg(*[
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("column") == i, F.col("text"))))["text"], separator).alias(c)
        for i, c in enumerate(columns)
    ])
    return joined
