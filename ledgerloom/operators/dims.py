"""Code lists as small DataFrames, and lookups against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom import fixed_values as fixed


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code_dim(spark: SparkSession, block: str) -> DataFrame:
    """``(code, label)`` of a fixed block: a local relation, so no job and a known size."""
    values = ", ".join(f"({_quoted(c)}, {_quoted(l)})" for c, l in fixed.pairs(block))
    return spark.sql(f"SELECT code, label FROM VALUES {values} AS t(code, label)")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: Column | str,
    out: str,
    default: Column | str | None = None,
    fixed_size: bool = False,
) -> DataFrame:
    """Add the label of ``key`` as column ``out``.

    Without a match: null, a constant text, or the given column (such as the code
    itself). The dim is broadcast when the caller says that it is one of the fixed code lists; a
    code list that was read from files has no such bound, so its join is left to the optimizer.
    """
    key = F.col(key) if isinstance(key, str) else key
    side = dim.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    joined = df.join(F.broadcast(side) if fixed_size else side, key == F.col("_code"), "left")
    label = F.col("_label")
    if default is not None:
        label = F.coalesce(label, default if isinstance(default, Column) else F.lit(default))
    return joined.withColumn(out, label).drop("_code", "_label")
