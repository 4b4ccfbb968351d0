"""Aid activities: the flat dataset and the reports made from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import clean, money, rules
from ledgerloom.operators.aggregates import (
    grouped, joined_text, ordered_lists, top_and_others, total, total_where,
)
from ledgerloom.operators.dims import code_dim, lookup
from ledgerloom.operators.joins import excluded, restricted, star, translated
from ledgerloom.operators.lists import PIECE, cells, numbered
from ledgerloom.operators.rank import first_per_key
from ledgerloom.operators.select import in_order, renamed, without
from ledgerloom.plans import single_country
from ledgerloom.session import cut

PUBLISHED = [name for name, _, _ in fixed.triples(fixed.AID_COLUMNS)]

#: Published column by the name it has inside; columns not listed here have one name only.
PUBLISHED_AS = {
    "aid": "id_projet", "title": "titre", "reporting": "bailleur_de_fonds", "status_label": "statut",
    "url": "lien_source", "multi_country": "projet_multi_pays",
    "spend_usd": "montant_verse_usd", "spend_eur": "montant_verse_eur", "spend_kmf": "montant_verse_kmf",
    "budget_usd": "budget_prevu_usd", "budget_eur": "budget_prevu_eur", "budget_kmf": "budget_prevu_kmf",
    "location_name": "localisation", "location_latitude": "latitudes", "location_longitude": "longitudes",
}


@dataclass(frozen=True)
class AidTables:
    """The tables of the first source, plus the translated copy of its activities."""

    act: DataFrame
    translation: DataFrame
    country: DataFrame
    sector: DataFrame
    budget: DataFrame
    trans: DataFrame
    location: DataFrame
    keys: DataFrame | None = None  # of activities with this country alone, where they were written once
    in_place: bool = False  # the tables lie in buckets of the activity key


# ------------------------------------------------------------------ activities

def shares(country: DataFrame, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """First positive share per activity; a missing share is 100."""
    share = clean.number_or(country, "country_percent", 100)
    return (
        country.where(F.col("country_code") == code)
        .select("aid", "ord", share.alias("share"))
        .where("share > 0")
        .groupBy("aid")
        .agg(F.min_by("share", "ord").alias("share"))
    )


def with_funder(df: DataFrame, match: str = "substring") -> DataFrame:
    """Donor country, class and region from the reporting reference and name."""
    country = rules.funder_country(F.col("reporting_ref"), F.col("reporting"), match)
    df = df.withColumn("pays_bailleur", country)
    df = df.withColumn("type_bailleur", rules.funder_type(F.col("pays_bailleur")))
    regions = code_dim(df.sparkSession, fixed.DONOR_REGIONS)
    return lookup(df, regions, "pays_bailleur", "region_bailleur", rules.OTHER, fixed_size=True)


def with_status(df: DataFrame) -> DataFrame:
    """Numeric status code and its label; unknown codes have no label."""
    statuses = code_dim(df.sparkSession, fixed.ACTIVITY_STATUS)
    statuses = statuses.withColumn("code", F.col("code").cast("double"))
    df = df.withColumn("status_code", clean.number_of(df, "status_code"))
    return lookup(df, statuses, "status_code", "status_label", fixed_size=True)


def activities(tables: AidTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Activities of a country with a positive share, one row each, enriched.

    Copies of an activity are reduced to the first one before anything is joined, so each
    join is one row to one row. All sides are hashed by ``aid`` once.
    """
    act = first_per_key(tables.act, ["aid"], ["ord"])
    translation = first_per_key(tables.translation, ["aid"], ["ord"])
    base = act.join(shares(tables.country, code), "aid")
    base = translated(base, translation, "aid", ["title", "description"])
    base = with_funder(with_status(base))
    return base.withColumns({
        "country_code": F.lit(code),
        "multi_country": clean.multi_country_flag(F.col("share")),
        "status_label": clean.status_text(F.col("status_code"), F.col("status_label")),
        "date_debut": clean.day_text(clean.number_of(base, "day_start")),
        "date_fin": clean.day_text(clean.number_of(base, "day_end")),
        "url": clean.activity_url(F.col("slug")),
    })


# ------------------------------------------------------------------ children, one row per activity

def sectors_per_activity(sector: DataFrame, in_place: bool = False) -> DataFrame:
    spark = sector.sparkSession
    lists = ordered_lists(
        sector, "aid", "ord", ["sector_code", "sector_group"],
        labels={
            "secteur_detail": ("sector_code", code_dim(spark, fixed.SECTORS)),
            "secteur_principal": ("sector_group", code_dim(spark, fixed.SECTOR_GROUPS)),
        },
        in_place=in_place,
    )
    return _as_text(lists)


def budgets_per_activity(budget: DataFrame, in_place: bool = False) -> DataFrame:
    """Planned amounts; they are not weighted by the country share.

    ``budget_value`` adds up original currencies as they are, which only makes sense
    next to the list of those currencies.
    """
    eur = clean.number_of(budget, "budget_eur")
    lists = ordered_lists(
        budget, "aid", "ord", ["budget_currency"],
        sums={
            "budget_value": clean.number_of(budget, "budget_value"),
            "budget_usd": clean.number_of(budget, "budget_usd"),
            "budget_eur": eur,
            "budget_kmf": money.aid_kmf(eur),
        },
        in_place=in_place,
    )
    return _as_text(lists)


def transactions_per_activity(trans: DataFrame, in_place: bool = False) -> DataFrame:
    """Unweighted sums by kind, count, and flow and finance codes, from one scan."""
    spark = trans.sparkSession
    usd, eur = clean.number_or(trans, "trans_usd", 0), clean.number_or(trans, "trans_eur", 0)
    kind = F.col("trans_code")
    lists = ordered_lists(
        trans, "aid", "ord", ["trans_flow_code", "trans_finance_code"],
        labels={
            "flux": ("trans_flow_code", code_dim(spark, fixed.FLOW_TYPES)),
            "financement": ("trans_finance_code", code_dim(spark, fixed.FINANCE_TYPES)),
        },
        sums={
            "spend_usd": F.when(kind.isin(fixed.SPEND_CODES), usd).otherwise(0.0),
            "spend_eur": F.when(kind.isin(fixed.SPEND_CODES), eur).otherwise(0.0),
            "expenditure_usd": F.when(kind == "E", usd).otherwise(0.0),
            "commitment_usd": F.when(kind.isin(fixed.COMMITMENT_CODES), usd).otherwise(0.0),
            "n_transactions": F.lit(1),
        },
        in_place=in_place,
    )
    texts = _as_text(lists).withColumn("_tokens", rules.code_tokens(F.col("trans_finance_code")))
    return texts.withColumn(
        "instrument_financement", rules.financing_instrument(F.col("_tokens"))
    ).drop("_tokens")


def weighted(df: DataFrame, amounts: list[str]) -> DataFrame:
    """Amounts times the share. The share is the same for all transactions of an activity,
    so weighting the sums equals summing weighted rows."""
    return df.withColumns({a: money.share_of(F.col(a), F.col("share")) for a in amounts})


PLACE = ["location_name", "location_latitude", "location_longitude"]


def places(location: DataFrame) -> DataFrame:
    """``aid, position, location_name, location_latitude, location_longitude``: the distinct places of an activity."""
    return numbered(location, "aid", "ord", PLACE)


def locations_per_activity(location: DataFrame, in_place: bool = False) -> DataFrame:
    """The published cells: names, latitudes and longitudes, each in order of first appearance.

    An activity with at most :data:`PIECE` location rows fits one array, and nearly all do. Where there are others, their
    cells are made from the numbered places, piece by piece; texts are the same either way.
    """
    large = location.groupBy("aid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PIECE).select("aid")
    if large.isEmpty():
        return _as_text(ordered_lists(location, "aid", "ord", PLACE, in_place=in_place))
    large = cut(large)
    small = _as_text(ordered_lists(excluded(location, large, "aid"), "aid", "ord", PLACE, in_place=in_place))
    return small.unionByName(cells(places(restricted(location, large, "aid")), "aid", PLACE))


def _as_text(lists: DataFrame) -> DataFrame:
    arrays = [f.name for f in lists.schema if f.dataType.typeName() == "array"]
    return lists.withColumns({a: joined_text(a) for a in arrays})


# ------------------------------------------------------------------ the dataset

def wide_dataset(
    tables: AidTables, code: str = fixed.COUNTRY_CODE, prefilter: bool = False
) -> DataFrame:
    """Everything known per activity, published or not, under the names used inside.

    ``prefilter`` semi-joins the child tables with the activities of the country first.
    It pays when the country is a small part of the registry (the key set is then
    broadcast); without it each child is aggregated as a whole and joined.
    """
    base = activities(tables, code)

    def child(df: DataFrame) -> DataFrame:
        return restricted(df, shares(tables.country, code), "aid") if prefilter else df

    in_place = getattr(tables, "in_place", False)
    joined = star(
        base, "aid",
        sectors_per_activity(child(tables.sector), in_place),
        budgets_per_activity(child(tables.budget), in_place),
        transactions_per_activity(child(tables.trans), in_place),
        locations_per_activity(child(tables.location), in_place),
    )
    joined = weighted(joined, ["spend_usd", "spend_eur", "expenditure_usd", "commitment_usd"])
    joined = joined.withColumn("spend_kmf", money.aid_kmf(F.col("spend_eur")))
    return without(joined, "slug", "day_start", "day_end")  # published as address and days


def dataset(tables: AidTables, code: str = fixed.COUNTRY_CODE, prefilter: bool = False) -> DataFrame:
    """The published dataset: 24 columns, one row per activity."""
    return in_order(renamed(wide_dataset(tables, code, prefilter), PUBLISHED_AS), PUBLISHED)


# ------------------------------------------------------------------ reports

def spend_per_activity(trans: DataFrame, dated_only: bool = False) -> DataFrame:
    """Unweighted disbursements and expenditures, one row per activity."""
    kept = trans.where(F.col("trans_code").isin(fixed.SPEND_CODES))
    if dated_only:
        kept = kept.where(F.col("trans_day").isNotNull())
    return kept.groupBy("aid").agg(
        total(clean.number_of(trans, "trans_usd")).alias("spend_usd"),
        total(clean.number_of(trans, "trans_eur")).alias("spend_eur"),
    )


def summary_order() -> list[Column | str]:
    """Largest spend first, then by the keys."""
    return [F.col("total_usd").desc_nulls_last(), "region_bailleur", "pays_bailleur", "type_bailleur"]


def donor_summary(tables: AidTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Weighted, dated spend by donor region, country and class, with money texts."""
    donors = with_funder(first_per_key(tables.act, ["aid"], ["ord"])).select(
        "aid", "region_bailleur", "pays_bailleur", "type_bailleur"
    )
    spend = spend_per_activity(tables.trans, dated_only=True)
    per_activity = weighted(
        donors.join(shares(tables.country, code), "aid").join(spend, "aid"),
        ["spend_usd", "spend_eur"],
    )
    summary = grouped(
        per_activity, ["region_bailleur", "pays_bailleur", "type_bailleur"],
        total(F.col("spend_usd")).alias("total_usd"),
        total(F.col("spend_eur")).alias("total_eur"),
        total(money.aid_kmf(F.col("spend_eur"))).alias("total_kmf"),
    )
    return summary.withColumns({
        "text_usd": money.usd_text(F.col("total_usd")),
        "text_eur": money.eur_text(F.col("total_eur")),
        "text_kmf": money.kmf_text(F.col("total_kmf")),
    }).orderBy(*summary_order())


def donor_totals(summary: DataFrame) -> DataFrame:
    """Grand totals; every spend belongs to exactly one line of the summary."""
    return summary.agg(*[total(F.col(c)).alias(c) for c in ("total_usd", "total_eur", "total_kmf")])


def donor_report(published: DataFrame, n: int = 4, others: str = "Autres") -> DataFrame:
    """Spend by funder: the n largest and one line for all others; a missing funder counts."""
    per_funder = grouped(
        published, ["bailleur_de_fonds"],
        F.count("id_projet").alias("nb_projets"),
        total(F.col("montant_verse_usd")).alias("montant_verse_usd"),
        total(F.col("montant_verse_eur")).alias("montant_verse_eur"),
        total(F.col("montant_verse_kmf")).alias("montant_verse_kmf"),
        null_keys=True,
    )
    report = top_and_others(
        per_funder, "bailleur_de_fonds",
        ["nb_projets", "montant_verse_usd", "montant_verse_eur", "montant_verse_kmf"],
        by="montant_verse_usd", n=n, others=others,
    )
    return report.withColumn("libelle", clean.shortened(F.col("bailleur_de_fonds"), 46))


def report_totals(report: DataFrame, published: DataFrame) -> DataFrame:
    """Totals of the report, and the number of activities and named funders behind it."""
    totals = report.agg(
        F.sum("nb_projets").alias("nb_projets"),
        *[total(F.col(f"montant_verse_{c}")).alias(f"total_{c}") for c in ("usd", "eur", "kmf")],
    )
    behind = published.agg(
        F.count(F.lit(1)).alias("n_projets"), F.count_distinct("bailleur_de_fonds").alias("n_bailleurs")
    )
    both = totals.unionByName(behind, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def status_counts(tables: AidTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Activities by status for sole recipients; one grouping of the country rows finds those."""
    kept = restricted(tables.act, single_country.by_sole_recipient(tables.country, code), "aid")
    return kept.groupBy("status_code").agg(F.count_distinct("aid").alias("n_activities"))


def sector_activity_count(
    tables: AidTables, sector_code: str = "12110", code: str = fixed.COUNTRY_CODE
) -> DataFrame:
    """Distinct activities of one sector among those of the sole recipient."""
    in_sector = tables.sector.where(F.col("sector_code") == sector_code).select("aid").distinct()
    known = restricted(in_sector, tables.act, "aid")
    kept = restricted(known, single_country.by_sole_recipient(tables.country, code), "aid")
    return kept.agg(F.count(F.lit(1)).alias("n_activities"))


def commitment_total(tables: AidTables, code: str = fixed.COUNTRY_CODE) -> DataFrame:
    """Sum of commitments of activities with a sole recipient."""
    per_activity = (
        tables.trans.where(F.col("trans_code").isin(fixed.COMMITMENT_CODES))
        .groupBy("aid").agg(total(clean.number_of(tables.trans, "trans_usd")).alias("usd"))
    )
    known = restricted(per_activity, tables.act, "aid")
    kept = restricted(known, single_country.by_sole_recipient(tables.country, code), "aid")
    return kept.agg(total(F.col("usd")).alias("commitment_usd"), F.count(F.lit(1)).alias("n_activities"))


def conditional_spend(trans: DataFrame) -> DataFrame:
    """Disbursements, expenditures, commitments and D+E per activity, in one pass."""
    usd = clean.number_or(trans, "trans_usd", 0)
    kind = F.col("trans_code")
    return trans.groupBy("aid").agg(
        total_where(kind == "D", usd).alias("disbursements_usd"),
        total_where(kind == "E", usd).alias("expenditures_usd"),
        total_where(kind == "C", usd).alias("commitments_usd"),
        total_where(kind.isin(fixed.SPEND_CODES), usd).alias("total_de_usd"),
        F.count(F.lit(1)).alias("n_transactions"),
    )
