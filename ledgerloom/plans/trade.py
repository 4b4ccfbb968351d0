"""Trade flows: year x flow x customs section x partner, in three currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import clean, money, rules
from ledgerloom.operators.dims import code_dim, lookup
from ledgerloom.operators.filters import traded
from ledgerloom.operators.select import run_date
from ledgerloom.operators.sets import stacked

PUBLISHED = [name for name, _, _ in fixed.triples(fixed.TRADE_COLUMNS)]
SORTED_BY = ["flux", "annee", "section_code", "partenaire_code_iso3"]


def facts(observations: DataFrame, rates: DataFrame, excluded_partners: list[str] | None = None) -> DataFrame:
    """The 13 published columns of flat trade observations.

    ``observations`` holds ``flux`` (X or M), ``section_code`` and the series attributes
    ``PARTNER``, ``TIME_PERIOD`` and ``OBS_VALUE`` (thousand USD). Years without a rate
    keep their USD value and have no EUR and KMF value. An unreadable value or period
    stops the job.
    """
    spark = observations.sparkSession
    rows = observations.select(
        rules.flow_name(F.col("flux")).alias("flux"),
        "section_code",
        F.col("PARTNER").alias("partenaire_code_iso3"),
        clean.strict_int(F.col("TIME_PERIOD"), "period", default=0).alias("annee"),
        clean.strict_number(F.col("OBS_VALUE"), "value").alias("_thousands"),
    ).where(traded(F.col("partenaire_code_iso3"), F.col("_thousands"), excluded_partners))
    rows = lookup(rows, code_dim(spark, fixed.HS_SECTIONS), "section_code", "section_libelle", F.col("section_code"))
    rows = lookup(
        rows, code_dim(spark, fixed.PARTNERS), "partenaire_code_iso3", "partenaire_pays",
        F.col("partenaire_code_iso3"),
    )
    rows = rows.join(rates.select("annee", F.col("taux").alias("taux_usd_eur")), "annee", "left")
    rows = rows.withColumn("valeur_usd", money.units_from_thousands(F.col("_thousands")))
    rows = rows.withColumn("valeur_eur", money.eur_from_usd(F.col("valeur_usd"), F.col("taux_usd_eur")))
    return rows.withColumns({
        "valeur_kmf": money.trade_kmf(F.col("valeur_eur")),
        "reporter_code": F.lit(fixed.COUNTRY_ISO3),
        "reporter_pays": F.lit(fixed.COUNTRY_NAME),
        "date_extraction": run_date(),
    }).select(*PUBLISHED)


def both_flows(exports: DataFrame, imports: DataFrame) -> DataFrame:
    """Exports and imports that landed apart; one folder with both is read in one scan instead."""
    return stacked(exports, imports)


def published_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in SORTED_BY]


def in_published_order(published: DataFrame) -> DataFrame:
    """Sorted for publication; a distributed range sort."""
    return published.orderBy(*published_order())


def statistics(published: DataFrame) -> DataFrame:
    """Rows per flow, sections, partners and covered years, in one row."""
    return published.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("flux") == "Export").alias("n_export"),
        F.count_if(F.col("flux") == "Import").alias("n_import"),
        F.count_distinct("section_code").alias("n_sections"),
        F.count_distinct("partenaire_code_iso3").alias("n_partners"),
        F.min("annee").alias("first_year"),
        F.max("annee").alias("last_year"),
    )
