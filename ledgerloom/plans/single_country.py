"""The four meanings of "this activity belongs to one country".

They give different sets; each has its own name so that they cannot be mixed up. Every
one returns distinct keys, ready for a semi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.clean import number_or
from ledgerloom.operators.filters import full_or_missing_share


def by_full_share(country: DataFrame, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Share is 100 once a missing or unreadable one counts as 100."""
    full = number_or(country, "country_percent", 100) == 100
    return country.where((F.col("country_code") == code) & full).select("aid").distinct()


def by_full_or_missing_share(country: DataFrame, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Share is stated as 100, or not stated."""
    kept = country.where((F.col("country_code") == code) & full_or_missing_share(country, "country_percent"))
    return kept.select("aid").distinct()


def by_single_row(recipient: DataFrame, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """One row of this country with a share of at least 99; other countries do not count."""
    return (
        recipient.where(F.col("code") == code)
        .groupBy("_link_activity")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(number_or(recipient, "percentage", 100)).alias("share"),
        )
        .where("n = 1 AND share >= 99")
        .select("_link_activity")
    )


def by_sole_recipient(country: DataFrame, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """One country row over all countries, and it is this country.

    One grouping replaces the join of a filter with a correlated count.
    """
    return (
        country.groupBy("aid")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("country_code") == code).alias("here"))
        .where("n = 1 AND here = 1")
        .select("aid")
    )
