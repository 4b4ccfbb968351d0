"""SDMX XML trade series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SERIES_ATTRIBUTES = ["FREQ", "REPORTER", "PARTNER", "PRODUCTCODE", "INDICATOR"]
OBS_ATTRIBUTES = ["TIME_PERIOD", "OBS_VALUE", "DATASOURCE"]


def series_schema(attributes: Iterable[str], audit: bool = False) -> T.StructType:
    """A series with its observations; either level may carry any of the attributes."""
    fields = [T.StructField(f"_{a}", T.StringType()) for a in attributes]
    schema = T.StructType(fields + [T.StructField("Obs", T.ArrayType(T.StructType(fields)))])
    return schema.add("_corrupt_record", T.StringType()) if audit else schema


def read_series(
    spark: SparkSession,
    path: str | list[str],
    attributes: Iterable[str] = (*SERIES_ATTRIBUTES, *OBS_ATTRIBUTES),
    audit: bool = False,
    root: str | None = None,
) -> DataFrame:
    """One row per ``Series`` element, whatever namespace prefix it has.

    Files are landed as ``flux=<X|M>/section_code=<code>/*.xml``; both come back as
    columns. With ``audit`` an unreadable section keeps its row in ``_corrupt_record``
    and the rest is still read. ``root`` is the folder above, where ``path`` lists some of its sections.
    """
    reader = spark.read.option("basePath", root) if root else spark.read
    return (
        reader.format("xml")
        .option("rowTag", "Series")
        .option("ignoreNamespace", "true")
        .option("mode", "PERMISSIVE" if audit else "FAILFAST")
        .schema(series_schema(attributes, audit))
        .load(path)
    )


def flatten_series(
    series: DataFrame,
    attributes: Iterable[str] = (*SERIES_ATTRIBUTES, *OBS_ATTRIBUTES),
    keep: Iterable[str] = (),
    doc: str | None = None,
) -> DataFrame:
    """One row per observation: its own attributes, overridden by those of its series."""
    at = f"{doc}." if doc else ""
    exploded = series.select(
        *keep,
        *[F.col(f"{at}_{a}").alias(f"_series_{a}") for a in attributes],
        F.explode(f"{at}Obs").alias("_obs"),
    )
    return exploded.select(
        *keep, *[F.coalesce(f"_series_{a}", f"_obs._{a}").alias(a) for a in attributes]
    )


def with_absent_sections(audit: DataFrame, flows: list[str], sections: list[str]) -> DataFrame:
    """The audit with a line of zeros for every known section and flow that never landed."""
    known = audit.sparkSession.createDataFrame(
        [(flow, section) for flow in flows for section in sections], "flux string, section_code string"
    )
    return known.join(audit, ["flux", "section_code"], "full").fillna(0, ["n_series", "n_obs", "n_unreadable"])


def section_audit(series: DataFrame, keys: list[str]) -> DataFrame:
    """Series, observations and unreadable records per landed section."""
    return series.groupBy(*keys).agg(
        F.count_if(F.col("_corrupt_record").isNull()).alias("n_series"),
        F.coalesce(F.sum(F.size(F.coalesce("Obs", F.array()))), F.lit(0)).alias("n_obs"),
        F.count("_corrupt_record").alias("n_unreadable"),
    )
