"""Typing and text clean-up of raw fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom import fixed_values as fixed

# what counts as blank around a text: all Unicode white space and the ASCII separators
BLANKS = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def number(c: Column) -> Column:
    """Number of a text; anything unreadable, and NaN, is null.

    Java reads a type suffix ("12d", "3.5f") as part of a number; here it is unreadable.
    """
    return F.nanvl(_plain_double(c), F.lit(None).cast("double"))


def _plain_double(c: Column) -> Column:
    """Number of a text without a type suffix; null where it is none."""
    text = c.cast("string")
    return F.when(~text.rlike(r"[0-9.]\s*[dDfF]\s*$"), text.try_cast("double"))


def number_of(df: DataFrame, name: str) -> Column:
    """Number of a column: texts are read by :func:`number`, numeric columns pass through."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return number(F.col(name))
    value = F.col(name).cast("double")
    return F.nanvl(value, F.lit(None).cast("double")) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def number_or(df: DataFrame, name: str, default: float) -> Column:
    return F.coalesce(number_of(df, name), F.lit(float(default)))


def strict_number(c: Column, name: str) -> Column:
    """Number of a text; null stays null, an unreadable text stops the job."""
    return _strict(c, "double", name)


def strict_int(c: Column, name: str, default: int | None = None) -> Column:
    value = _strict(c, "int", name)
    return value if default is None else F.coalesce(value, F.lit(default))


def _strict(c: Column, kind: str, name: str) -> Column:
    value = _plain_double(c) if kind == "double" else c.try_cast(kind)
    failure = F.raise_error(F.concat(F.lit(f"unreadable {name}: "), c.cast("string")))
    return F.when(c.isNull() | value.isNotNull(), value).otherwise(failure.cast(kind))


def stripped(c: Column) -> Column:
    """Text without blanks at either end (line ends and no-break blanks included)."""
    return F.trim(c, F.lit(BLANKS))


def day_text(c: Column) -> Column:
    """``yyyy-MM-dd`` of a day number counted from 1970-01-01."""
    day = F.floor(c.try_cast("double")).try_cast("int")
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd")


def year_of_iso(c: Column) -> Column:
    return F.substring(c, 1, 4)


def year_of_day(c: Column, encoding: str = "yyyymmdd") -> Column:
    """Year, as text, of a day that is stored as an integer.

    The same source uses two encodings, so the caller names the one that applies.
    """
    if encoding == "yyyymmdd":
        return F.call_function("div", c.try_cast("bigint"), F.lit(10000)).cast("string")
    if encoding == "epoch_day":
        return F.date_format(F.date_from_unix_date(c.try_cast("int")), "yyyy")
    raise ValueError(f"unknown day encoding: {encoding}")


def multi_country_flag(share: Column) -> Column:
    """"Non" for a full share, "Oui" for any other."""
    return F.when(share == 100, "Non").otherwise("Oui")


def status_text(code: Column, label: Column) -> Column:
    """``code_label`` when both are known, else the label."""
    joined = F.concat_ws("_", code.cast("int").cast("string"), label)
    return F.when(code.isNotNull() & label.isNotNull(), joined).otherwise(label)


def activity_url(slug: Column) -> Column:
    """Page of an activity; null without a slug."""
    return F.concat(F.lit(fixed.ACTIVITY_URL_START), slug.cast("string"), F.lit(fixed.ACTIVITY_URL_END))


def shortened(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)
