"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.clean import number_of, number_or


def full_or_missing_share(df: DataFrame, percent: str) -> Column:
    """Share is 100, or not stated; an unreadable one is neither."""
    return F.coalesce(number_of(df, percent) == 100, F.lit(False)) | F.col(percent).isNull()


def positive_share(df: DataFrame, percent: str) -> Column:
    """Share over 0 once a missing one counts as 100."""
    return number_or(df, percent, 100) > 0


def traded(partner: Column, value: Column, excluded: list[str] | None = None) -> Column:
    """A real partner with a value that is neither missing nor 0."""
    excluded = fixed.WORLD_PARTNERS if excluded is None else excluded
    return ~F.coalesce(partner, F.lit("")).isin(excluded) & value.isNotNull() & (value != 0)


def code_starts_with(code: Column, prefix: str) -> Column:
    return code.cast("string").startswith(prefix)


def text_contains(text: Column, part: str) -> Column:
    """Contains, in any case; a null text does not."""
    return F.coalesce(F.contains(F.lower(text), F.lower(F.lit(part))), F.lit(False))
