"""Joins that keep the left side one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.aggregates import total


def translated(df: DataFrame, translation: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Translated text where there is one, else the text itself.

    The translation must hold one row per key.
    """
    side = translation.select(
        F.col(key), *[F.col(c).alias(f"_t_{c}") for c in columns]
    )
    joined = df.join(side, key, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(f"_t_{c}"), F.col(c)) for c in columns}
    ).drop(*[f"_t_{c}" for c in columns])


def star(base: DataFrame, key: str, *children: DataFrame) -> DataFrame:
    """Left joins of children that hold one row per key.

    Every child was grouped by the key, so it arrives hashed by it and only the base
    has to move.
    """
    for child in children:
        base = base.join(child, key, "left")
    return base


def with_measures(df: DataFrame, measures: DataFrame, key: str) -> DataFrame:
    """Left join of measures, 0 where there are none."""
    names = [c for c in measures.columns if c != key]
    return df.join(measures, key, "left").fillna(0, names)


def restricted(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """Rows whose key is in the key set (semi join, no fan-out).

    Copies in the key set are removed before they travel; where it is known to be
    distinct the optimizer drops that step.
    """
    side = keys.select(F.col(keys_key or key).alias("_key")).distinct()
    return df.join(side, F.col(key) == F.col("_key"), "left_semi")


def excluded(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the key set; a null key is in no set."""
    side = keys.select(F.col(keys_key or key).alias("_key")).distinct()
    return df.join(side, F.col(key) == F.col("_key"), "left_anti")


def sums_per_key(df: DataFrame, key: str, amount: Column, out: str) -> DataFrame:
    """Sum per key, made before any join: what joins later is one row per key."""
    return df.groupBy(key).agg(total(amount).alias(out))


def outer_by(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with missing measures as 0."""
    joined = left.join(right, key, "full_outer")
    return joined.fillna(0, [c for c in joined.columns if c != key])


def looked_up(
    df: DataFrame, snapshot: DataFrame, key: str, snapshot_key: str, found: Column, asked: Column
) -> DataFrame:
    """Three-way existence check against a snapshot: found, not found, unanswered."""
    side = snapshot.withColumnRenamed(snapshot_key, "_key")
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    status = (
        F.when(F.col("_key").isNull() | ~asked, "unanswered")
        .when(found, "found")
        .otherwise("not_found")
    )
    return joined.withColumn("registry_status", status).drop("_key")
