"""The second publication of the aid data: its own activity dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import clean
from ledgerloom.operators.aggregates import grouped, total
from ledgerloom.operators.joins import restricted, star
from ledgerloom.operators.select import in_order

PUBLISHED = [
    "aid", "title", "reporting", "status_label", "date_debut", "date_fin",
    "montant_verse_usd_iati_tables", "budget_raw_iati_tables", "projet_multi_pays", "country_percent",
]


@dataclass(frozen=True)
class SecondTables:
    activity: DataFrame
    recipient: DataFrame
    breakdown: DataFrame
    budget: DataFrame
    keys: DataFrame | None = None  # of activities with this country alone, where they were written once


def is_spend(code: str) -> Column:
    """Disbursements and expenditures in the country; amounts are already split by country."""
    return (F.col("recipientcountry_code") == code) & F.col("transactiontype_code").isin(fixed.SPEND_TYPES)


def activities(tables: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Distinct activity and share rows of a country.

    Two different shares of one activity stay two rows, as the published query has it.
    The recipients are made distinct before the join as well: copies there would only be
    removed after it.
    """
    recipients = tables.recipient.where(F.col("code") == code).select("_link_activity", "percentage").distinct()
    rows = tables.activity.join(recipients, F.col("_link") == F.col("_link_activity")).select(
        F.col("iatiidentifier").alias("aid"),
        F.col("title_narrative").alias("title"),
        "description",
        F.col("reportingorg_narrative").alias("reporting"),
        F.col("reportingorg_ref").alias("reporting_ref"),
        F.col("activitystatus_code").alias("status_code"),
        F.col("activitystatus_codename").alias("status_label"),
        F.col("actualstart").alias("date_debut"),
        F.col("actualend").alias("date_fin"),
        F.col("percentage").alias("country_percent"),
    )
    rows = rows.repartition("aid").distinct()  # one shuffle for this step and the joins by aid
    rows = rows.withColumn("country_percent", clean.number_or(rows, "country_percent", 100))
    return rows.withColumn("projet_multi_pays", clean.multi_country_flag(F.col("country_percent")))


def spend_rows(tables: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Spend transactions under the names of the first source."""
    return tables.breakdown.where(is_spend(code)).select(
        F.col("iatiidentifier").alias("aid"),
        F.col("transactiontype_code").alias("trans_code"),
        F.col("transactiontype_codename").alias("trans_label"),
        F.col("transactiondate_isodate").alias("trans_date"),
        clean.number_or(tables.breakdown, "value_usd", 0).alias("trans_usd"),
        F.col("value_currency").alias("trans_currency"),
        F.col("value").alias("trans_value_original"),
        F.col("value_valuedate").alias("value_date"),
        "sector_code", "sector_codename", "recipientcountry_code", "percentage_used",
    )


def budget_rows(tables: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Budgets of activities with a row of the country, in their original currency."""
    links = tables.recipient.where(F.col("code") == code).select("_link_activity").distinct()
    return restricted(tables.budget, links, "_link_activity").select(
        "_link_activity",
        clean.number_or(tables.budget, "value", 0).alias("budget_value"),
        F.col("value_currency").alias("budget_currency"),
        F.col("iatiidentifier").alias("aid"),
    )


def dataset(tables: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Activities with their spend (0 without any) and raw budget (null without any)."""
    spend = grouped(
        spend_rows(tables, code), ["aid"], total(F.col("trans_usd")).alias("montant_verse_usd_iati_tables")
    )
    budget = grouped(
        budget_rows(tables, code), ["aid"], total(F.col("budget_value")).alias("budget_raw_iati_tables")
    )
    joined = star(activities(tables, code), "aid", spend, budget)
    return in_order(joined.fillna(0, ["montant_verse_usd_iati_tables"]), PUBLISHED)


def spend_by_status(published: DataFrame) -> DataFrame:
    """Activities and spend by status, largest spend first; no status, no line."""
    return grouped(
        published, ["status_label"],
        F.count("montant_verse_usd_iati_tables").alias("nb_activites"),
        total(F.col("montant_verse_usd_iati_tables")).alias("total_usd"),
    ).orderBy(F.col("total_usd").desc_nulls_last())


def multi_country_split(published: DataFrame) -> DataFrame:
    return grouped(
        published, ["projet_multi_pays"], F.count(F.lit(1)).alias("n_activities")
    ).orderBy(F.col("n_activities").desc())


def spend_total(published: DataFrame) -> DataFrame:
    """Total spend, each identifier once even where two shares give it two rows."""
    once = published.groupBy("aid").agg(F.max("montant_verse_usd_iati_tables").alias("usd"))
    return once.agg(F.count(F.lit(1)).alias("n_activities"), total(F.col("usd")).alias("total_usd"))
