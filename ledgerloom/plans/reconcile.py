"""Comparison of the two publications of the aid data.

Keys stay distributed: every "identifier in list" is a semi or anti join. Amounts are
added up per activity before they meet the keys, so an activity with very many
transactions joins as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import clean, gaps
from ledgerloom.operators.aggregates import gap_spread, grouped, long_form, total
from ledgerloom.operators.joins import (
    excluded, looked_up, outer_by, restricted, sums_per_key, with_measures,
)
from ledgerloom.operators.rank import largest
from ledgerloom.operators.select import run_date
from ledgerloom.operators.sets import dealt, identifiers, membership, only_in
from ledgerloom.plans import single_country
from ledgerloom.plans.aid import AidTables, conditional_spend
from ledgerloom.plans.second_source import SecondTables, is_spend


def exclusive_order() -> list[Column | str]:
    return [F.col("total_usd").desc(), "aid"]


def missing_order() -> list[Column | str]:
    return [F.col("total_de_usd").desc_nulls_last(), "iati_identifier"]


# ------------------------------------------------------------------ keys and spend of each side

def first_keys(first: AidTables, code: str) -> DataFrame:
    known = getattr(first, "keys", None) if code == fixed.COUNTRY_CODE else None
    return single_country.by_full_or_missing_share(first.country, code) if known is None else known


def second_keys(second: SecondTables, code: str) -> DataFrame:
    known = getattr(second, "keys", None) if code == fixed.COUNTRY_CODE else None
    return single_country.by_single_row(second.recipient, code) if known is None else known


def first_spend(trans: DataFrame) -> DataFrame:
    """``aid, dp_usd``: spend per activity of the first source."""
    kept = trans.where(F.col("trans_code").isin(fixed.SPEND_CODES))
    return sums_per_key(kept, "aid", clean.number_of(trans, "trans_usd"), "dp_usd")


def second_spend(breakdown: DataFrame, key: str, code: str) -> DataFrame:
    return sums_per_key(
        breakdown.where(is_spend(code)), key, clean.number_of(breakdown, "value_usd"), "it_usd"
    )


def first_activities(first: AidTables, code: str, parts: int | None = None) -> DataFrame:
    return restricted(first.act, dealt(first_keys(first, code), "aid", parts), "aid")


def second_activities(second: SecondTables, code: str, parts: int | None = None) -> DataFrame:
    keys = dealt(second_keys(second, code), "_link_activity", parts)
    return restricted(second.activity, keys, "_link", "_link_activity")


def first_identifiers(first: AidTables, code: str, parts: int | None = None) -> DataFrame:
    return identifiers(first_activities(first, code, parts), "aid")


def second_identifiers(second: SecondTables, code: str, parts: int | None = None) -> DataFrame:
    return identifiers(second_activities(second, code, parts), "iatiidentifier")


# ------------------------------------------------------------------ totals

def total_gap(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Total spend of both sides, gap and verdict, in one row."""
    it = restricted(
        second_spend(second.breakdown, "_link_activity", code), second_keys(second, code), "_link_activity"
    ).agg(total(F.col("it_usd")).alias("it_usd"))
    dp = restricted(first_spend(first.trans), first_keys(first, code), "aid").agg(
        total(F.col("dp_usd")).alias("dp_usd"), F.count(F.lit(1)).alias("dp_activities")
    )
    row = _side_by_side(it, dp)
    percent = gaps.gap_percent(F.col("it_usd"), F.col("dp_usd"))
    return row.withColumns({
        "gap_usd": F.col("it_usd") - F.col("dp_usd"), "gap_pct": percent,
    }).withColumn("verdict", gaps.total_verdict(F.col("gap_pct")))


def total_check(
    second: SecondTables, reference_usd: float = fixed.AID_TOTAL_REFERENCE_USD, code: str = fixed.COUNTRY_CODE
) -> DataFrame:
    """Total spend of the second source against a known figure.

    Activities are counted once over all of the data, not per batch of keys.
    """
    spend = second.breakdown.where(is_spend(code)).groupBy("_link_activity", "iatiidentifier").agg(
        total(clean.number_of(second.breakdown, "value_usd")).alias("it_usd")
    )
    kept = restricted(spend, second_keys(second, code), "_link_activity")
    row = kept.agg(
        F.count_distinct("iatiidentifier").alias("n_activities"), total(F.col("it_usd")).alias("it_usd")
    )
    reference = F.lit(float(reference_usd))
    return row.withColumns({
        "gap_usd": F.col("it_usd") - reference,
        "gap_pct": gaps.gap_percent(F.col("it_usd"), reference),
    }).withColumn("verdict", gaps.check_verdict(F.col("gap_pct")))


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row results in one row."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# ------------------------------------------------------------------ years

def year_gap(
    first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE, day_encoding: str = "yyyymmdd"
) -> DataFrame:
    """Spend by year on both sides, gap and flag.

    Spend is added up per activity and year first: what joins the keys has at most one
    row per activity and year.
    """
    it = (
        second.breakdown.where(is_spend(code) & F.col("transactiondate_isodate").isNotNull())
        .withColumn("year", clean.year_of_iso(F.col("transactiondate_isodate")))
        .groupBy("_link_activity", "year")
        .agg(total(clean.number_of(second.breakdown, "value_usd")).alias("it_usd"))
    )
    dp = (
        first.trans.where(F.col("trans_code").isin(fixed.SPEND_CODES) & F.col("trans_day").isNotNull())
        .withColumn("year", clean.year_of_day(F.col("trans_day"), day_encoding))
        .groupBy("aid", "year")
        .agg(total(clean.number_of(first.trans, "trans_usd")).alias("dp_usd"))
    )
    it_years = grouped(
        restricted(it, second_keys(second, code), "_link_activity"), ["year"],
        total(F.col("it_usd")).alias("it_usd"),
    )
    dp_years = grouped(
        restricted(dp, first_keys(first, code), "aid"), ["year"], total(F.col("dp_usd")).alias("dp_usd")
    )
    both = outer_by(it_years, dp_years, "year").withColumns({
        "gap_usd": F.col("it_usd") - F.col("dp_usd"),
        "gap_pct": gaps.gap_percent(F.col("it_usd"), F.col("dp_usd")),
    })
    return both.withColumn("flagged", gaps.material_gap(F.col("gap_pct"), F.col("dp_usd"))).orderBy("year")


def year_dispersion(years: DataFrame, floor: float = 1e5) -> DataFrame:
    """How even the gaps of the material years are."""
    spread = gap_spread(years.where(F.col("dp_usd") > floor), "gap_pct")
    return spread.withColumn("verdict", gaps.spread_verdict(F.col("spread"), F.col("n_gaps")))


# ------------------------------------------------------------------ activities

def _with_first_spend(top: DataFrame, key: str, trans: DataFrame) -> DataFrame:
    """A few rows with their spend in the first source as ``dp_usd``, 0 without any.

    Their limit tells the optimizer how few they are; a
    zero amount per row keeps those without transactions. Both uses of ``top`` need the
    same columns, so that Spark computes it once.
    """
    # equal rows stay apart by their number
    top = top.withColumn("_row", F.row_number().over(Window.orderBy(*top.columns)))
    usd = clean.number_of(trans, "trans_usd").alias("_usd")
    spend = trans.where(F.col("trans_code").isin(fixed.SPEND_CODES)).select(F.col("aid").alias("_aid"), usd)
    found = spend.join(top, F.col("_aid") == F.col(key)).select(*top.columns, "_usd")
    nothing = top.withColumn("_usd", F.lit(0.0))
    return found.unionByName(nothing).groupBy(*top.columns).agg(
        total(F.col("_usd")).alias("dp_usd")
    ).drop("_row")


def spot_check(
    first: AidTables, second: SecondTables, n: int = 10, code: str = fixed.COUNTRY_CODE
) -> DataFrame:
    """The n largest activities of the second source, looked up in the first.

    Keys and names of n activities at most travel.
    """
    spend = restricted(
        second_spend(second.breakdown, "_link_activity", code), second_keys(second, code), "_link_activity"
    )
    top = largest(spend, n, "it_usd", "_link_activity")
    links = top.select(F.col("_link_activity").alias("_top"))
    names = second.activity.join(links, F.col("_link") == F.col("_top"), "left_semi").select(
        F.col("_link").alias("_link_activity"),
        F.nullif(clean.stripped(F.col("iatiidentifier")), F.lit("")).alias("identifier"),
        F.col("reportingorg_narrative").alias("reporter"),
    )
    named = top.join(names, "_link_activity", "left")
    named = largest(named, n, "it_usd", "_link_activity", "identifier")
    joined = _with_first_spend(named, "identifier", first.trans)
    dp = F.when(F.col("identifier").isNotNull(), F.col("dp_usd"))
    return joined.withColumn("dp_usd", dp).withColumns({
        "gap_pct": gaps.gap_percent(F.col("it_usd"), F.col("dp_usd")),
        "gap_text": gaps.spot_text(F.col("identifier"), F.col("it_usd"), F.col("dp_usd")),
    }).orderBy(F.col("it_usd").desc_nulls_last(), "_link_activity")


def spot_counts(spot: DataFrame) -> DataFrame:
    """How many of the checked activities the first source has, and how many it lacks."""
    return spot.agg(
        F.count_if(F.col("dp_usd") > 0).alias("matched"),
        F.count_if((F.col("dp_usd") == 0) & F.col("identifier").isNotNull()).alias("missing"),
    ).withColumn("verdict", F.when(F.col("missing") == 0, "all_present").otherwise("some_missing"))


# ------------------------------------------------------------------ identifier sets

def id_sets(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """One row per identifier: is it in the first source, is it in the second?"""
    return membership(first_identifiers(first, code), second_identifiers(second, code))


def id_verdict(sets: DataFrame) -> DataFrame:
    counts = sets.agg(
        F.count_if(F.col("in_first") & F.col("in_second")).alias("in_both"),
        F.count_if(F.col("in_first") & ~F.col("in_second")).alias("only_first"),
        F.count_if(~F.col("in_first") & F.col("in_second")).alias("only_second"),
    )
    return counts.withColumn("verdict", gaps.set_verdict(F.col("only_first"), F.col("only_second")))


def exclusive_value(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Spend of every activity that only the first source has, largest first."""
    acts = first_activities(first, code).select("aid").distinct().withColumn("_id", clean.stripped(F.col("aid")))
    alone = excluded(acts.where("_id IS NOT NULL"), second_identifiers(second, code), "_id", "identifier")
    spend = restricted(first_spend(first.trans), alone, "aid")
    return spend.withColumnRenamed("dp_usd", "total_usd").orderBy(*exclusive_order())


def exclusive_total(value: DataFrame) -> DataFrame:
    """How many activities :func:`exclusive_value` lists, and their total."""
    return value.agg(F.count(F.lit(1)).alias("n_activities"), total(F.col("total_usd")).alias("total_usd"))


def exclusive_second(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Every activity that only the second source has, with its publisher."""
    acts = second_activities(second, code).withColumn("_id", clean.stripped(F.col("iatiidentifier")))
    alone = excluded(acts.where("_id IS NOT NULL"), first_identifiers(first, code), "_id", "identifier")
    return alone.orderBy("_link").select(
        F.col("iatiidentifier").alias("identifier"), F.col("reportingorg_narrative").alias("reporter")
    )


def shared_gaps(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Every activity that both sources have, with its gap.

    Identifiers are compared, and amounts matched, without blanks around them. Both sides are
    added up per identifier before they meet.
    """
    spend = second.breakdown.where(is_spend(code)).groupBy("_link_activity", "iatiidentifier").agg(
        total(clean.number_of(second.breakdown, "value_usd")).alias("it_usd")
    )
    it = grouped(
        restricted(spend, second_keys(second, code), "_link_activity")
        .withColumn("_id", clean.stripped(F.col("iatiidentifier"))),
        ["_id"], total(F.col("it_usd")).alias("it_usd"),
    ).withColumnRenamed("_id", "iatiidentifier")
    both = id_sets(first, second, code).where("in_first AND in_second")
    dp = grouped(
        first_spend(first.trans).withColumn("_id", clean.stripped(F.col("aid"))),
        ["_id"], total(F.col("dp_usd")).alias("dp_usd"),
    ).withColumnRenamed("_id", "iatiidentifier")
    joined = with_measures(restricted(it, both, "iatiidentifier", "identifier"), dp, "iatiidentifier").withColumns({
        "gap_usd": F.col("it_usd") - F.col("dp_usd"),
        "gap_pct": gaps.gap_percent(F.col("it_usd"), F.col("dp_usd")),
    })
    return joined.withColumn("flagged", gaps.exceeds(F.col("gap_pct"), 20))


def shared_top(shared: DataFrame, n: int = 20) -> DataFrame:
    """The n largest of the shared activities."""
    return largest(shared, n, "it_usd", "iatiidentifier").orderBy(
        F.col("it_usd").desc_nulls_last(), "iatiidentifier"
    )


def shared_dispersion(shared: DataFrame) -> DataFrame:
    """Median and spread of the gaps of all shared activities."""
    spread = gap_spread(shared, "gap_pct")
    return spread.withColumn(
        "verdict", F.when(F.col("spread") < 5, "uniform").otherwise("variable")
    )


# ------------------------------------------------------------------ missing activities

def tracked(first: AidTables, second: SecondTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Activities of the first source with their spend and ``in_second``."""
    acts = first_activities(first, code).select(
        "aid", "reporting", "reporting_ref", "title", "status_code", "day_start", "day_end"
    )
    spend = conditional_spend(first.trans).select(
        "aid", "disbursements_usd", "expenditures_usd", "total_de_usd"
    )
    known = second_identifiers(second, code).select(
        F.col("identifier").alias("_known"), F.lit(True).alias("in_second")
    )
    return (
        with_measures(acts, spend, "aid")
        .join(known, clean.stripped(F.col("aid")) == F.col("_known"), "left")
        .withColumn("in_second", F.coalesce("in_second", F.lit(False)))
        .drop("_known")
    )


def missing_detail(flagged: DataFrame) -> DataFrame:
    """Activities that the second source lacks, largest spend first."""
    return flagged.where(~F.col("in_second")).select(
        F.col("aid").alias("iati_identifier"),
        F.col("reporting").alias("reporting_org"),
        F.col("reporting_ref").alias("reporting_org_ref"),
        F.col("title").alias("activity_title"),
        "status_code",
        F.col("day_start").alias("start_date"),
        F.col("day_end").alias("end_date"),
        "disbursements_usd", "expenditures_usd", "total_de_usd",
    ).orderBy(*missing_order())


def missing_by_publisher(flagged: DataFrame) -> DataFrame:
    return grouped(
        flagged.where(~F.col("in_second")), ["reporting"],
        F.count("aid").alias("n_activities"), total(F.col("total_de_usd")).alias("total_de_usd"),
    ).withColumnRenamed("reporting", "publisher").orderBy(F.col("total_de_usd").desc_nulls_last(), "publisher")


def missing_figures(flagged: DataFrame) -> DataFrame:
    """Counts, spend and coverage gap in one row."""
    present, usd = F.col("in_second"), F.col("total_de_usd")
    row = flagged.agg(
        F.count(F.lit(1)).alias("n_activities"),
        F.count_if(present).alias("n_present"),
        F.count_if(~present).alias("n_missing"),
        total(F.when(present, usd)).alias("present_usd"),
        total(F.when(~present, usd)).alias("missing_usd"),
        total(usd).alias("all_usd"),
    )
    return row.withColumn("gap_pct", gaps.coverage_percent(F.col("missing_usd"), F.col("all_usd")))


def missing_summary(figures: DataFrame) -> DataFrame:
    """The figures as published: one metric per row, with the run date."""
    return long_form(figures, [
        ("run_date", run_date()),
        ("activities", F.col("n_activities")),
        ("present", F.col("n_present")),
        ("missing", F.col("n_missing")),
        ("present_usd", F.bround("present_usd", 2).cast("decimal(38,2)")),
        ("missing_usd", F.bround("missing_usd", 2).cast("decimal(38,2)")),
        ("coverage_gap_pct", F.col("gap_pct")),
    ])


def registry_status(
    first: AidTables, second: SecondTables, registry: DataFrame, code: str = fixed.COUNTRY_CODE
) -> DataFrame:
    """Missing identifiers in order, with what a registry snapshot knows about them.

    Where an identifier has several publishers the last one in arrival order is shown. Repeated
    lines of the snapshot count once: the most occurrences, checked if any line says so.
    """
    registry = registry.groupBy("identifier").agg(
        F.max("occurrences").alias("occurrences"), F.bool_or("checked").alias("checked")
    )
    acts = first_activities(first, code)
    publishers = (
        acts.select(clean.stripped(F.col("aid")).alias("identifier"), "reporting", "ord")
        .where("identifier IS NOT NULL")
        .groupBy("identifier").agg(F.max_by("reporting", "ord").alias("reporting"))
    )
    missing = only_in(publishers, second_identifiers(second, code))
    status = looked_up(
        missing, registry, "identifier", "identifier",
        found=F.col("occurrences").isNotNull(), asked=F.coalesce("checked", F.lit(False)),
    )
    publisher = clean.stripped(F.coalesce("reporting", F.lit("")))
    return status.select(
        "identifier", "registry_status",
        F.when(F.col("registry_status") == "found", F.col("occurrences")).alias("occurrences"),
        publisher.alias("publisher"),
    ).orderBy("identifier")


def registry_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("registry_status").agg(F.count(F.lit(1)).alias("n")).orderBy("registry_status")

