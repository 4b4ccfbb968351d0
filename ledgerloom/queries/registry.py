"""Registered queries by name; each takes ``(spark, sf_dir)`` and gives a DataFrame.

Sums of floating-point money depend on the order of addition in their last digits, so
results are rounded to digits at which that does not show and no value is a tie: dollars of
the first source have three decimals once weighted, those of the second four.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom import fixed_values as fixed, landing, schemas
from ledgerloom.functions import clean, money, rules
from ledgerloom.operators import aggregates, dims, filters, joins, rank, select, sets
from ledgerloom.plans import aid, reconcile, releases, second_source, single_country, trade
from ledgerloom.queries import standins
from ledgerloom.session import shared_folder
from ledgerloom.sources import envelopes, rates, sdmx, trade_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


DIGITS = {"kmf": 0, "eur": 2}


def rounded(df: DataFrame, *names: str, digits: int | None = None) -> DataFrame:
    return df.withColumns({
        n: F.round(F.col(n), DIGITS.get(n[-3:], 4) if digits is None else digits) for n in names
    })


def rounded_totals(df: DataFrame, *names: str) -> DataFrame:
    """Totals over many activities, by currency at the end of the name."""
    return df.withColumns({n: F.round(F.col(n), {"usd": 3, "eur": 1, "kmf": 0}[n[-3:]]) for n in names})


# ------------------------------------------------------------------ aid: reports and dataset

def _amounts_by_funder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the published dataset that the funder report reads."""
    tables = standins.aid_tables(spark, sf_dir)
    spend = aid.spend_per_activity(tables.trans)
    acts = rank.first_per_key(tables.act, ["aid"], ["ord"]).select("aid", "reporting")
    weighted = aid.weighted(
        joins.star(acts.join(aid.shares(tables.country), "aid"), "aid", spend), ["spend_usd", "spend_eur"]
    )
    return weighted.select(
        F.col("aid").alias("id_projet"),
        F.col("reporting").alias("bailleur_de_fonds"),
        F.col("spend_usd").alias("montant_verse_usd"),
        F.col("spend_eur").alias("montant_verse_eur"),
        money.aid_kmf(F.col("spend_eur")).alias("montant_verse_kmf"),
    )


@query
def donor_top4_autres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend of the four largest funders and of all others, over the whole registry."""
    report = aid.donor_report(_amounts_by_funder(spark, sf_dir))
    return rounded_totals(report, "montant_verse_usd", "montant_verse_eur", "montant_verse_kmf")


@query
def donor_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = _amounts_by_funder(spark, sf_dir)
    totals = aid.report_totals(aid.donor_report(published), published)
    return rounded_totals(totals, "total_usd", "total_eur", "total_kmf")


@query
def activity_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dataset, 24 columns."""
    published = aid.dataset(standins.aid_tables(spark, sf_dir))
    return rounded(published, *[f"{kind}_{c}" for kind in ("montant_verse", "budget_prevu") for c in ("usd", "eur", "kmf")])


@query
def landed_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dataset from landed tables: written once in buckets of the activity key, then grouped and joined there."""
    views = standins.aid_tables(spark, sf_dir)
    base = f"{shared_folder(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    sources = [f"{sf_dir}/{name}.parquet" for name in ("orders", "customer", "lineitem", "part", "supplier")]
    buckets = landing.buckets_for_files(spark, sources, 12)
    tables = {}
    for name in ("act", "translation", "country", "sector", "budget", "trans", "location"):
        view = getattr(views, name)
        landing.write_in_buckets(view, f"{base}/{name}", "aid", ["ord"], buckets)
        tables[name] = landing.open_in_buckets(spark, f"{base}/{name}", view.schema, "aid", ["ord"], buckets)
    published = aid.dataset(aid.AidTables(**tables, in_place=True))
    return rounded(published, *[f"{kind}_{c}" for kind in ("montant_verse", "budget_prevu") for c in ("usd", "eur", "kmf")])


@query
def donor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = aid.donor_summary(standins.aid_tables(spark, sf_dir))
    return rounded_totals(summary, "total_usd", "total_eur", "total_kmf")


@query
def donor_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = aid.donor_totals(aid.donor_summary(standins.aid_tables(spark, sf_dir)))
    return rounded_totals(totals, *totals.columns)


@query
def activity_country_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities with a row of the country."""
    tables = standins.aid_tables(spark, sf_dir)
    here = tables.country.where(F.col("country_code") == fixed.COUNTRY_CODE)
    return tables.act.join(here, "aid").select("aid", "title", "reporting_ref", "country_code", "country_percent")


@query
def sector_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aid.sector_activity_count(standins.aid_tables(spark, sf_dir))


@query
def title_coalesce_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = standins.aid_tables(spark, sf_dir)
    return joins.translated(
        tables.act.select("aid", "title", "description"), tables.translation, "aid", ["title", "description"]
    )


@query
def share_positive_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = standins.country(spark, sf_dir)
    kept = country.where(filters.positive_share(country, "country_percent"))
    share = clean.number_or(country, "country_percent", 100)
    return kept.select(
        "aid", "country_code", share.alias("share"), clean.multi_country_flag(share).alias("multi_country")
    )


@query
def share_null_or_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = standins.country(spark, sf_dir)
    return country.where(filters.full_or_missing_share(country, "country_percent")).select(
        "aid", "country_code", "country_percent"
    )


@query
def status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = aid.with_status(standins.act(spark, sf_dir).select("aid", "status_code"))
    return acts.withColumn("status", clean.status_text(F.col("status_code"), F.col("status_label")))


@query
def funder_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = standins.act(spark, sf_dir).select("aid", "reporting", "reporting_ref")
    return aid.with_funder(acts)


@query
def funder_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities per donor class, most frequent first."""
    acts = aid.with_funder(standins.act(spark, sf_dir).select("reporting", "reporting_ref"))
    return aggregates.grouped(acts, ["type_bailleur"], F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc())


@query
def instrument_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_activity = aid.transactions_per_activity(standins.trans(spark, sf_dir))
    return per_activity.select("aid", "instrument_financement")


@query
def ordered_distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aid.sectors_per_activity(standins.sector(spark, sf_dir))


@query
def flow_and_finance_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_activity = aid.transactions_per_activity(standins.trans(spark, sf_dir))
    return per_activity.select("aid", "trans_flow_code", "flux", "trans_finance_code", "financement")


@query
def location_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aid.locations_per_activity(standins.location(spark, sf_dir))


@query
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct places of each activity as rows, numbered in order of first appearance."""
    return aid.places(standins.aid_tables(spark, sf_dir).location)


@query
def budget_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    budgets = aid.budgets_per_activity(standins.budget(spark, sf_dir))
    return rounded(budgets, "budget_value", "budget_usd", "budget_eur", "budget_kmf")


@query
def trans_weighted_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by kind per activity, weighted by the share of the country."""
    tables = standins.aid_tables(spark, sf_dir)
    spend = aid.conditional_spend(tables.trans)
    amounts = ["disbursements_usd", "expenditures_usd", "commitments_usd", "total_de_usd"]
    weighted = aid.weighted(spend.join(aid.shares(tables.country), "aid"), amounts)
    return rounded(weighted, *amounts)


@query
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line item of every order."""
    lines = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return rank.first_per_key(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query
def date_text_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = standins.act(spark, sf_dir)
    return acts.select(
        "aid",
        clean.day_text(clean.number_of(acts, "day_start")).alias("date_debut"),
        clean.day_text(clean.number_of(acts, "day_end")).alias("date_fin"),
        clean.activity_url(F.col("slug")).alias("url"),
    )


@query
def code_label_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector codes with their labels, and whether the first code is a numeric one."""
    lists = aid.sectors_per_activity(standins.sector(spark, sf_dir))
    return lists.select(
        "aid",
        rules.code_label_text(F.col("sector_code"), F.col("secteur_detail")).alias("sectors"),
        rules.is_section_code(F.col("sector_code")).alias("numeric_code"),
    )


@query
def single_country_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aid.status_counts(standins.aid_tables(spark, sf_dir))


@query
def commitment_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = aid.commitment_total(standins.aid_tables(spark, sf_dir))
    return rounded_totals(total, "commitment_usd")


@query
def single_country_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_country.by_single_row(standins.second_recipient(spark, sf_dir))


@query
def full_share_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_country.by_full_share(standins.country(spark, sf_dir))


# ------------------------------------------------------------------ second source

@query
def second_source_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = second_source.dataset(standins.second_tables(spark, sf_dir))
    return rounded(published, "montant_verse_usd_iati_tables", "budget_raw_iati_tables")


@query
def spend_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = second_source.dataset(standins.second_tables(spark, sf_dir))
    return rounded(second_source.spend_by_status(published), "total_usd", digits=1)


@query
def multi_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return second_source.multi_country_split(second_source.dataset(standins.second_tables(spark, sf_dir)))


@query
def second_source_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = second_source.dataset(standins.second_tables(spark, sf_dir))
    return rounded(second_source.spend_total(published), "total_usd", digits=1)


# ------------------------------------------------------------------ reconciliation

def _both(spark: SparkSession, sf_dir: str):
    return standins.aid_tables(spark, sf_dir), standins.second_tables(spark, sf_dir)


@query
def total_gap_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = reconcile.total_gap(*_both(spark, sf_dir))
    return rounded(rounded_totals(rounded(gap, "it_usd", "gap_usd", digits=1), "dp_usd"), "gap_pct")


@query
def total_check_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = reconcile.total_check(standins.second_tables(spark, sf_dir))
    return rounded(rounded(check, "it_usd", "gap_usd", digits=1), "gap_pct")


@query
def year_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = reconcile.year_gap(*_both(spark, sf_dir))
    return rounded(rounded_totals(rounded(years, "it_usd", "gap_usd", digits=1), "dp_usd"), "gap_pct")


@query
def gap_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = reconcile.year_gap(*_both(spark, sf_dir))
    return rounded(reconcile.year_dispersion(years), "spread", "median_gap")


@query
def top10_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    spot = reconcile.spot_check(*_both(spark, sf_dir))
    return rounded(spot, "it_usd", "dp_usd", "gap_pct")


@query
def top10_spot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.spot_counts(reconcile.spot_check(*_both(spark, sf_dir)))


@query
def id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.id_sets(*_both(spark, sf_dir))


@query
def id_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.id_verdict(reconcile.id_sets(*_both(spark, sf_dir)))


@query
def id_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three sets by set operations on distinct identifiers, in parts that follow the source files."""
    first, second = _both(spark, sf_dir)
    sources = [f"{sf_dir}/{name}.parquet" for name in ("orders", "supplier")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) + landing.buckets_for_files(spark, sources, 1)
    a = reconcile.first_identifiers(first, fixed.COUNTRY_CODE, parts)
    b = reconcile.second_identifiers(second, fixed.COUNTRY_CODE, parts)
    of_a, of_b = (sets.dealt(known, "identifier", parts) for known in (a, b))
    return sets.stacked(
        sets.only_in(a, of_b).withColumn("part", F.lit("only_first")),
        sets.only_in(b, of_a).withColumn("part", F.lit("only_second")),
        sets.in_both(a, of_b).withColumn("part", F.lit("in_both")),
    )


@query
def exclusive_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reconcile.exclusive_value(*_both(spark, sf_dir)), "total_usd")


@query
def exclusive_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_totals(reconcile.exclusive_total(reconcile.exclusive_value(*_both(spark, sf_dir))), "total_usd")


@query
def exclusive_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.exclusive_second(*_both(spark, sf_dir))


@query
def shared_top20_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = reconcile.shared_top(reconcile.shared_gaps(*_both(spark, sf_dir)))
    return rounded(top, "it_usd", "dp_usd", "gap_usd", "gap_pct")


@query
def shared_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = reconcile.shared_gaps(*_both(spark, sf_dir))
    return rounded(reconcile.shared_dispersion(shared), "spread", "median_gap")


@query
def missing_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = reconcile.missing_detail(reconcile.tracked(*_both(spark, sf_dir)))
    return rounded(detail, "disbursements_usd", "expenditures_usd", "total_de_usd")


@query
def missing_by_publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reconcile.missing_by_publisher(reconcile.tracked(*_both(spark, sf_dir))), "total_de_usd")


@query
def missing_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = reconcile.missing_figures(reconcile.tracked(*_both(spark, sf_dir)))
    return rounded_totals(figures, "present_usd", "missing_usd", "all_usd")


@query
def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = reconcile.missing_figures(reconcile.tracked(*_both(spark, sf_dir)))
    return reconcile.missing_summary(figures).where("metric <> 'run_date'")


@query
def registry_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.registry_status(*_both(spark, sf_dir), standins.registry(spark, sf_dir))


@query
def registry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = reconcile.registry_status(*_both(spark, sf_dir), standins.registry(spark, sf_dir))
    return reconcile.registry_counts(status)


# ------------------------------------------------------------------ trade

@query
def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published trade dataset without its run date, in published order."""
    facts = trade.facts(standins.observations(spark, sf_dir), rates.fallback_rates(spark))
    return trade.in_published_order(facts).drop("date_extraction")


@query
def trade_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = trade.facts(standins.observations(spark, sf_dir), rates.fallback_rates(spark))
    return trade.statistics(facts)


@query
def latest_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases still to load, for every reporter, newest period first."""
    waiting = releases.pending(standins.releases(spark, sf_dir), standins.loaded(spark, sf_dir), order="ord")
    return releases.latest_first(waiting, "reporterCode").select("reporterCode", "period", "fileUrl")


@query
def period_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per reporter and week day of early 2024; the last asked days have none."""
    days = [f"202401{d:02d}" for d in range(1, 32)] + ["20240201", "20240202"]
    return releases.availability(standins.releases(spark, sf_dir), days)


@query
def code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.search_codes(standins.code_list(spark, sf_dir), prefix="1", contains="RING")


# ------------------------------------------------------------------ published order

@query
def donor_summary_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The donor summary with the place of each line, largest spend first."""
    return rank.positioned(donor_summary(spark, sf_dir), aid.summary_order())


@query
def trade_facts_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade dataset with the place of each row in published order."""
    facts = trade.facts(standins.observations(spark, sf_dir), rates.fallback_rates(spark))
    return rank.positioned(facts.drop("date_extraction"), trade.published_order())


@query
def year_gap_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.positioned(year_gap(spark, sf_dir), ["year"])


@query
def exclusive_value_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.positioned(exclusive_value(spark, sf_dir), reconcile.exclusive_order())


@query
def missing_detail_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.positioned(missing_detail(spark, sf_dir), reconcile.missing_order())


@query
def registry_status_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.positioned(registry_status(spark, sf_dir), ["identifier"])


@query
def latest_releases_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases still to load with their place, newest period first in each reporter."""
    return rank.positioned(latest_releases(spark, sf_dir), ["reporterCode", releases.newest()])


# ------------------------------------------------------------------ unions, pages, envelopes, documents

@query
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as one list of parties; suppliers have no segment."""
    customers = standins.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return sets.stacked(customers, suppliers)


@query
def page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of the orders by price."""
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return select.page(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], size=50, number=1)

@query
def page_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page out of orders that were sorted and numbered once."""
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return select.Pages(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], size=50).page(1)


@query
def page_firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of every page of 50."""
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return select.Pages(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], size=50).firsts()


@query
def object_envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country rows as one answer per order and read back; refused answers hold no rows."""
    documents = standins.table(spark, sf_dir, "orders").selectExpr(f"""
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
          THEN to_json(named_struct('error', 'time-out'))
          ELSE to_json(named_struct('rows', {standins.COUNTRY_ROWS})) END AS body""")
    schema = envelopes.object_envelope(
        T.StructType([schemas.COUNTRY[n] for n in ("aid", "country_code", "country_percent")])
    )
    return envelopes.object_rows(documents.select(F.from_json("body", schema).alias("doc")), "doc", on_error="skip")


@query
def array_envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget rows as one answer per order, with columns in changing order, and read back."""
    link, identifier = "concat('L', o_orderkey)", "cast(o_orderkey AS string)"
    documents = standins.table(spark, sf_dir, "orders").selectExpr(f"""
        to_json(CASE WHEN o_orderstatus = 'O'
          THEN named_struct('ok', o_orderpriority <> '1-URGENT',
            'columns', array('iatiidentifier', 'value_currency', '_link_activity'),
            'rows', array(array({identifier}, o_orderpriority, {link})))
          ELSE named_struct('ok', o_orderpriority <> '1-URGENT',
            'columns', array('_link_activity', 'iatiidentifier', 'value_currency'),
            'rows', array(array({link}, {identifier}, o_orderpriority))) END) AS body""")
    parsed = documents.select(F.from_json("body", envelopes.ARRAY_ENVELOPE).alias("doc"))
    return envelopes.array_rows(parsed, schemas.T_BUDGET, "doc", on_error="skip")


@query
def xml_series_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade observations written as series elements and read back, one row per observation.

    A series holds one observation per year; one without a value has no such attribute.
    """
    seen = standins.observations(spark, sf_dir)
    value = F.concat(F.lit(' OBS_VALUE="'), F.col("OBS_VALUE").cast("decimal(24,5)").cast("string"), F.lit('"'))
    observation = F.concat(
        F.lit('<Obs TIME_PERIOD="'), F.col("TIME_PERIOD"), F.lit('"'), F.coalesce(value, F.lit("")), F.lit("/>")
    )
    series = seen.groupBy("flux", "section_code", "PARTNER").agg(
        F.array_join(F.collect_list(observation), "").alias("observations")
    )
    documents = series.select("flux", "section_code", F.concat(
        F.lit('<Series FREQ="A" PARTNER="'), F.col("PARTNER"), F.lit('">'), "observations", F.lit("</Series>")
    ).alias("body"))
    attributes = ["FREQ", "PARTNER", "TIME_PERIOD", "OBS_VALUE"]
    parsed = documents.select("flux", "section_code", F.from_xml(
        "body", sdmx.series_schema(attributes), {"rowTag": "Series", "mode": "FAILFAST"}
    ).alias("doc"))
    return sdmx.flatten_series(parsed, attributes, keep=["flux", "section_code"], doc="doc")


@query
def translated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations as one answer per order and language, read back in one language and laid over the activities."""
    own = standins.translation(spark, sf_dir).drop("ord")
    answer = F.to_json(F.struct(F.array(F.struct("aid", "title", "description")).alias("rows")))
    documents = own.select(F.lit("fr").alias("lang"), answer.alias("body")).unionByName(
        own.withColumn("title", F.lit("Auftrag")).select(F.lit("de").alias("lang"), answer.alias("body"))
    )
    schema = envelopes.object_envelope(T.StructType([f for f in schemas.ACT_TRANSLATION if f.name != "ord"]))
    parsed = documents.where("lang = 'fr'").select(F.from_json("body", schema).alias("doc"))
    acts = standins.act(spark, sf_dir).select("aid", "title", "description")
    return joins.translated(acts, envelopes.object_rows(parsed, "doc"), "aid", ["title", "description"])


@query
def live_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest order price of each year as one live rate document, which the built-in rates give way to."""
    per_year = standins.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.min("o_totalprice").alias("lowest")
    )
    listed = per_year.agg(F.array_sort(F.collect_list(F.struct("year", "lowest"))).alias("years"))  # a few years
    rate = F.transform("years", lambda y, i: F.struct(i.cast("string").alias("key"), F.array(y.lowest).alias("value")))
    periods = F.array(F.struct(F.transform("years", lambda y: F.struct(y.year.cast("string").alias("id"))).alias("values")))
    body = F.to_json(F.struct(
        F.array(F.struct(F.create_map(
            F.lit(rates.SERIES_KEY), F.struct(F.map_from_entries(rate).alias("observations"))
        ).alias("series"))).alias("dataSets"),
        F.struct(F.struct(periods.alias("observation")).alias("dimensions")).alias("structure"),
    ))
    live = rates.rates_of(listed.select(F.from_json(body, rates.RATE_DOCUMENT).alias("doc")), "doc")
    return rates.rates_or_fallback(live, rates.fallback_rates(spark))


def _release_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.releases(spark, sf_dir).select(F.to_json(F.struct(
        F.array(F.struct("reporterCode", "period", "fileUrl")).alias("data")
    )).alias("body"))
    parsed = rows.select(F.from_json("body", trade_files.RELEASE_LIST).alias("doc"))
    return trade_files.listed_rows(parsed, "data", "doc")


@query
def release_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases as one answer per event, read back."""
    return _release_answers(spark, sf_dir)


@query
def releases_of_reporter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.of_reporter(_release_answers(spark, sf_dir), 7)


@query
def code_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as one code list answer each, read back."""
    answers = standins.code_list(spark, sf_dir).select(F.to_json(F.struct(F.array(F.struct("id", "text")).alias("results"))).alias("body"))
    return trade_files.listed_rows(answers.select(F.from_json("body", trade_files.CODE_LIST).alias("doc")), "results", "doc")


@query
def availability_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type as availability answers, read back and listed by period."""
    counted = standins.table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("period"), "event_type").agg(
        F.count("*").alias("totalRecords"), F.max(F.date_format("ts", "yyyy-MM-dd")).alias("lastReleased")
    )
    line = F.struct("period", F.upper("event_type").alias("reporterISO"), F.col("event_type").alias("reporterDesc"), "totalRecords", "lastReleased")
    answers = counted.select(F.to_json(F.struct(F.array(line).alias("data"))).alias("body"))
    parsed = answers.select(F.from_json("body", trade_files.AVAILABILITY_LIST).alias("doc"))
    return releases.available_periods(trade_files.listed_rows(parsed, "data", "doc"))


def _bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as compressed bulk files and read back by the reader of bulk files."""
    lines = standins.table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("period"), F.col("l_suppkey").cast("string").alias("reporterCode"),
        F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("cmdCode"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 'M' ELSE 'X' END").alias("flowCode"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("primaryValue"),
    )
    folder = f"{shared_folder(spark).rstrip('/')}/bulk-{uuid.uuid4().hex}"
    lines.write.option("header", "true").option("compression", "gzip").csv(folder)
    return trade_files.read_bulk(spark, folder, schemas.RECORDS)


@query
def bulk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bulk(spark, sf_dir)


@query
def selected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports of two years by some reporters, and exports of one commodity, out of the bulk files."""
    records = _bulk(spark, sf_dir)
    imports = trade_files.select_records(records, period=["1996", "1997"], reporter=["1", "2", "3", "4", "5"], flow=["M"])
    return imports.unionByName(trade_files.select_records(records, commodity=["000007"], flow=["X"]))


@query
def section_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series, observations and unreadable records per section, absent sections included; one section breaks off."""
    seen = standins.observations(spark, sf_dir)
    series = seen.groupBy("flux", "section_code", "PARTNER").agg(F.array_join(F.collect_list(
        F.concat(F.lit('<Obs TIME_PERIOD="'), F.col("TIME_PERIOD").cast("string"), F.lit('"/>'))
    ), "").alias("observations"))
    end = F.when((F.col("flux") == "M") & (F.col("section_code") == "27-27_Fuels"), "</Ser").otherwise("</Series>")
    body = F.concat(F.lit('<Series PARTNER="'), F.col("PARTNER"), F.lit('">'), F.col("observations"), end)
    parsed = series.select("flux", "section_code", F.from_xml(
        body, sdmx.series_schema(["PARTNER", "TIME_PERIOD"], audit=True), {"rowTag": "Series", "mode": "PERMISSIVE"}
    ).alias("doc")).select("flux", "section_code", "doc.*")
    sections = [code for code, _ in fixed.pairs(fixed.HS_SECTIONS)]
    return sdmx.with_absent_sections(sdmx.section_audit(parsed, ["flux", "section_code"]), ["X", "M"], sections)


@query
def both_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports and imports that landed apart, as one dataset."""
    facts = trade.facts(standins.observations(spark, sf_dir), rates.fallback_rates(spark)).drop("date_extraction")
    flux = F.col("flux")
    return trade.both_flows(facts.where(flux == "Export"), facts.where(flux == "Import"))


@query
def rate_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly mean order price per customer, written as rate documents and read back.

    Years are listed in order and observations refer to their place; the lowest years of
    urgent orders only have no observation.
    """
    per_year = standins.table(spark, sf_dir, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("year")
    ).agg(
        F.min("o_totalprice").alias("lowest"), F.bool_and(F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    listed = per_year.groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct("year", "lowest", "urgent"))).alias("years")
    )
    present = F.transform("years", lambda y, i: F.struct(
        i.cast("string").alias("key"), F.array(F.when(~y.urgent, y.lowest)).alias("value")
    ))
    observation = F.array(F.struct(
        F.transform("years", lambda y: F.struct(y.year.cast("string").alias("id"))).alias("values")
    ))
    documents = listed.select("o_custkey", F.to_json(F.struct(
        F.array(F.struct(F.create_map(
            F.lit(rates.SERIES_KEY), F.struct(F.map_from_entries(present).alias("observations"))
        ).alias("series"))).alias("dataSets"),
        F.struct(F.struct(observation.alias("observation")).alias("dimensions")).alias("structure"),
    ), {"ignoreNullFields": "false"}).alias("body"))
    parsed = documents.select("o_custkey", F.from_json("body", rates.RATE_DOCUMENT).alias("doc"))
    return rates.rates_of(parsed, "doc", keep=("o_custkey",))
