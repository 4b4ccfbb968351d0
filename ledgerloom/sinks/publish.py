"""Published products: versions of named datasets in place of a workbook of sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.operators.rank import positioned
from ledgerloom.operators.select import run_date, with_constants
from ledgerloom.plans import reconcile, trade
from ledgerloom.sinks.versions import Version, read_version


class UndocumentedColumn(ValueError):
    """A published column has no line in the dictionary, or the other way round."""


def dictionary(spark: SparkSession, block: str) -> DataFrame:
    """``colonne, source, description`` rows in published order."""
    return spark.createDataFrame(fixed.triples(block), "colonne string, source string, description string")


def documented(df: DataFrame, block: str) -> DataFrame:
    """The dataset with each description as column comment; the dictionary must cover it."""
    described = {name: text for name, _, text in fixed.triples(block)}
    apart = set(df.columns) ^ set(described)
    if apart:
        raise UndocumentedColumn(", ".join(sorted(apart)))
    return df.select(*[F.col(c).alias(c, metadata={"comment": described[c]}) for c in df.columns])


def publish(
    version: Version, df: DataFrame, block: str, fmt: str = "parquet", partition_by: list[str] | None = None,
    sorted_by: list[str] | None = None,
) -> DataFrame:
    """Data and its dictionary, as ``data`` and ``metadata`` of a version; the data as written."""
    data = version.add("data", documented(df, block), fmt, partition_by, sorted_by)
    version.add("metadata", dictionary(df.sparkSession, block).coalesce(1), fmt)
    return data


def publish_aid(version: Version, df: DataFrame, fmt: str = "parquet") -> DataFrame:
    return publish(version, df, fixed.AID_COLUMNS, fmt)


def publish_trade(version: Version, df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Trade facts by year and flow, so that readers of one year or flow prune the rest."""
    return publish(version, df, fixed.TRADE_COLUMNS, fmt, ["annee", "flux"], trade.SORTED_BY)


def comparison_notes(spark: SparkSession) -> DataFrame:
    """Method notes of the second-source dataset, the last one with the run time."""
    notes = spark.createDataFrame(fixed.pairs(fixed.COMPARISON_NOTES), "point string, valeur string")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm")
    run = spark.range(1).select(F.lit("Date extraction").alias("point"), stamp.alias("valeur"))
    return notes.unionByName(run)


def publish_comparison(version: Version, df: DataFrame, fmt: str = "parquet") -> DataFrame:
    data = version.add("comparison", df, fmt)
    version.add("notes", comparison_notes(df.sparkSession).coalesce(1), fmt)
    return data


def publish_tracker(version: Version, flagged: DataFrame) -> None:
    """A snapshot of the missing-activity tracker, with its date.

    The flagged activities are written first; the three reports read that table, so the
    comparison itself runs once and survives the loss of executors.
    """
    stored = version.add("activities", with_constants(flagged, run_date=run_date()), partition_by=["in_second"])
    version.add("missing", positioned(reconcile.missing_detail(stored), reconcile.missing_order()), sorted_by=["position"])
    version.add("by_publisher", reconcile.missing_by_publisher(stored))
    version.add("summary", reconcile.missing_summary(reconcile.missing_figures(stored)))


def read_published(spark: SparkSession, path: str, name: str = "data", ordered: bool = False) -> DataFrame:
    """A dataset of the newest whole version, with its types and in its column order."""
    return read_version(spark, path, name, ordered)
