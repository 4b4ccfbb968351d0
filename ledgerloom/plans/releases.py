"""What a trade reporter has released, what is loaded, and code list search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.operators.filters import code_starts_with, text_contains
from ledgerloom.operators.rank import first_per_key


def of_reporter(releases: DataFrame, reporter: int = fixed.COUNTRY_M49) -> DataFrame:
    return releases.where(F.col("reporterCode") == reporter)


def newest() -> Column:
    """Newest period first; a missing period sorts as an empty text."""
    return F.coalesce("period", F.lit("")).desc()


def latest_first(releases: DataFrame, *more: Column | str) -> DataFrame:
    return releases.orderBy(*more, newest())


def loaded_releases(releases: DataFrame, manifest: DataFrame) -> DataFrame:
    """Reporter and period of the releases whose file ``<reporter>_<period>.csv`` is in the manifest, with rows or without."""
    files = manifest.select(F.regexp_extract("file_name", r"^(.*?)\.csv", 1).alias("_name")).distinct()
    name = F.concat_ws("_", F.col("reporterCode").cast("string"), "period")
    return releases.select("reporterCode", "period").distinct().join(files, name == F.col("_name"), "left_semi")


def pending(releases: DataFrame, loaded: DataFrame, order: str | None = None) -> DataFrame:
    """Releases with a file that is not loaded yet, one per reporter and period.

    ``loaded`` is the manifest of earlier runs. Its file is named by period, so a second
    release of the same period is not fetched again.
    """
    with_file = releases.where(F.coalesce(F.col("fileUrl"), F.lit("")) != "")
    once = first_per_key(with_file, ["reporterCode", "period"], [order or "fileUrl"])
    done = loaded.select(F.col("reporterCode").alias("_reporter"), F.col("period").alias("_period")).distinct()
    return once.join(
        done,
        (F.col("reporterCode") == F.col("_reporter")) & F.col("period").eqNullSafe(F.col("_period")),
        "left_anti",
    )


def availability(records: DataFrame, periods: list[str]) -> DataFrame:
    """Records per reporter and asked period, and whether there are any.

    The asked periods come from a list, so each reporter is expanded in place; periods
    that were not asked for do not show.
    """
    counted = records.groupBy("reporterCode", "period").agg(F.count(F.lit(1)).alias("n_records"))
    spine = records.select("reporterCode").distinct().select(
        "reporterCode", F.explode(F.lit(periods)).alias("period")
    )
    return (
        spine.join(counted, ["reporterCode", "period"], "left")
        .fillna(0, ["n_records"])
        .withColumn("has_data", F.col("n_records") > 0)
    )


def available_periods(listing: DataFrame) -> DataFrame:
    """The published availability list, by period."""
    return listing.select("period", "reporterISO", "reporterDesc", "totalRecords", "lastReleased").orderBy("period")


def search_codes(codes: DataFrame, prefix: str | None = None, contains: str | None = None) -> DataFrame:
    """Code list rows by code prefix and by text in any case."""
    if prefix is not None:
        codes = codes.where(code_starts_with(F.col("id"), prefix))
    if contains is not None:
        codes = codes.where(text_contains(F.col("text"), contains))
    return codes.select("id", "text")
