"""Gap measures between two publications of the same figures, and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.money import round_cents

TOTAL_LADDER = [(2, "excellent"), (5, "good"), (10, "moderate")]
CHECK_LADDER = [(5, "equivalent"), (10, "freshness")]


def gap_percent(value: Column, base: Column) -> Column:
    """Difference in percent of the base; null for a base of 0."""
    return (value - base) / F.nullif(base, F.lit(0.0)) * 100


def verdict(percent: Column, ladder: list[tuple[float, str]], last: str) -> Column:
    """First step whose limit the absolute gap stays under; a null gap takes the last."""
    result = None
    for limit, name in ladder:
        below = F.abs(percent) < limit
        result = F.when(below, name) if result is None else result.when(below, name)
    return result.otherwise(last)


def total_verdict(percent: Column) -> Column:
    return verdict(percent, TOTAL_LADDER, "significant")


def check_verdict(percent: Column) -> Column:
    return verdict(percent, CHECK_LADDER, "investigate")


def exceeds(percent: Column, limit: float) -> Column:
    """Is the absolute gap over the limit? False for a null gap."""
    return F.coalesce(F.abs(percent) > limit, F.lit(False))


def material_gap(percent: Column, base: Column, limit: float = 10, floor: float = 1e5) -> Column:
    return exceeds(percent, limit) & (base > floor)


def spread_verdict(spread: Column, n: Column, limit: float = 5) -> Column:
    """Uniform gaps point to exchange rates, variable ones to missing data."""
    return F.when(n == 0, F.lit(None).cast("string")).when(spread < limit, "uniform").otherwise("variable")


def spot_text(identifier: Column, value: Column, other: Column) -> Column:
    """Outcome of one spot check; the percent keeps one decimal and its sign."""
    percent = F.call_function(
        "format_number", gap_percent(value, other), F.lit("+0.0;-0.0")
    )
    return (
        F.when(F.coalesce(identifier, F.lit("")) == "", "N/A")
        .when(other == 0, "+100.0%")
        .otherwise(F.concat(percent, F.lit("%")))
    )


def coverage_percent(part: Column, whole: Column) -> Column:
    return round_cents(part / F.nullif(whole, F.lit(0.0)) * 100)


def set_verdict(only_first: Column, only_second: Column) -> Column:
    return (
        F.when((only_first == 0) & (only_second == 0), "identical")
        .when(only_first == 0, "second_has_more")
        .when(only_second == 0, "first_has_more")
        .otherwise("both_diverge")
    )
