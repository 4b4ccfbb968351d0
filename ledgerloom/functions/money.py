"""Amounts: weighting, conversion, rounding, text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom import fixed_values as fixed


def round_cents(c: Column) -> Column:
    """Two decimals, half to even, decided on the exact binary value.

    ``bround`` decides on the printed decimal, which differs only near a half cent; just
    those values go through ``format_number``, which looks at the binary value.
    """
    near = F.bround(c, 2)
    exact = F.call_function("format_number", c, F.lit("0.00")).try_cast("double")
    return F.when(F.abs(F.abs(c - near) - 0.005) < 0.001, F.coalesce(exact, near)).otherwise(near)


def share_of(amount: Column, percent: Column) -> Column:
    return amount * (percent / 100)


def aid_kmf(eur: Column) -> Column:
    return eur * F.lit(fixed.AID_KMF_PER_EUR)


def units_from_thousands(thousands: Column) -> Column:
    return round_cents(thousands * 1000)


def eur_from_usd(usd: Column, usd_per_eur: Column) -> Column:
    """Null when the rate is missing or 0."""
    return round_cents(usd / F.nullif(usd_per_eur, F.lit(0.0)))


def trade_kmf(eur: Column) -> Column:
    return F.rint(eur * F.lit(fixed.TRADE_KMF_PER_EUR))


def usd_text(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 0))


def eur_text(c: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(c, 0))


def kmf_text(c: Column) -> Column:
    return F.concat(F.format_number(c, 0), F.lit(" KMF"))
