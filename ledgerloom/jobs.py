"""Jobs from landed files to published datasets.

    spark-submit --py-files ledgerloom.zip -m ledgerloom.jobs <job> --landed <folder> --out <folder>

or, in a local session, ``python -m ledgerloom.jobs <job> ...``. Landing layout:

    first/<act|country|sector|budget|trans|location>/*.json   answers of the first source
    first/act_translated/lang=fr/*.json                       translated titles and descriptions
    second/<activity|recipientcountry|transaction_breakdown|budget>/*.json
    trade/flux=<X|M>/section_code=<code>/*.xml                trade series
    rates/*.json                                              yearly exchange rates
    releases/*.json, bulk/*.csv                               releases, and their files
    registry/ (Parquet)                                       identifier registry snapshot

Raw files are parsed once, by whichever job comes first (:mod:`ledgerloom.landing`). A job's datasets are one version of
its product (:mod:`ledgerloom.sinks.versions`): written one after the other, each read back where a later one needs it,
and shown to readers together at the end, unless an input that must have rows has none.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from ledgerloom import fixed_values as fixed, landing, schemas
from ledgerloom.operators.rank import positioned
from ledgerloom.operators.select import with_constants
from ledgerloom.plans import aid, reconcile, releases, second_source, trade
from ledgerloom.session import build_session
from ledgerloom.sinks.publish import publish_aid, publish_comparison, publish_tracker, publish_trade
from ledgerloom.sinks.versions import Version
from ledgerloom.sources import rates, sdmx, trade_files
from ledgerloom.streaming import incremental


def aid_job(spark: SparkSession, landed: str, out: str) -> None:
    """The aid dataset, the donor summary, the places and the report of the largest funders."""
    tables, rows = landing.first_source(spark, landed, out)
    version = Version(spark, f"{out}/aid")
    published = publish_aid(version, aid.dataset(tables, prefilter=True))
    ordered = positioned(aid.donor_summary(tables), aid.summary_order())
    summary = version.add("donor_summary", ordered, sorted_by=["position"])
    version.add("donor_totals", aid.donor_totals(summary))
    version.add("places", aid.places(tables.location), sorted_by=["aid", "position"])
    report = version.add("donor_report", aid.donor_report(published), sorted_by=["position"])
    version.add("donor_report_totals", aid.report_totals(report, published))
    version.commit(rows, required=[name for name in rows if name != "translation"])


def counts_job(spark: SparkSession, landed: str, out: str) -> None:
    """Figures over activities with this country as the only recipient."""
    tables, rows = landing.first_source(spark, landed, out)
    version = Version(spark, f"{out}/counts")
    version.add("by_status", aid.status_counts(tables))
    version.add("sector", aid.sector_activity_count(tables))
    version.add("commitments", aid.commitment_total(tables))
    version.commit(rows, required=["act", "country", "sector", "trans"])


def trade_job(spark: SparkSession, landed: str, out: str) -> None:
    """The trade dataset, its statistics, an audit of the landed sections and what could not be read in them."""
    series = landing.land_series(spark, f"{landed}/trade", f"{out}/landed/trade")
    version = Version(spark, f"{out}/trade")
    sections = [code for code, _ in fixed.pairs(fixed.HS_SECTIONS)]
    version.add("audit", sdmx.with_absent_sections(series.sections, ["X", "M"], sections))
    version.add("unreadable", series.unreadable)
    live = rates.read_rates(spark, f"{landed}/rates")
    facts = publish_trade(
        version, trade.facts(series.observations, rates.rates_or_fallback(live, rates.fallback_rates(spark)))
    )
    version.add("statistics", trade.statistics(facts))
    observations = series.sections.agg(F.sum("n_obs")).first()[0] or 0
    version.commit({"observations": observations}, required=["observations"])


def comparison_job(spark: SparkSession, landed: str, out: str) -> None:
    """The dataset of the second source and its summaries."""
    tables, rows = landing.second_source(spark, landed, out)
    version = Version(spark, f"{out}/second_source")
    published = publish_comparison(version, second_source.dataset(tables))
    version.add("total", second_source.spend_total(published))
    version.add("by_status", second_source.spend_by_status(published))
    version.add("multi_country", second_source.multi_country_split(published))
    version.commit(rows, required=["activity", "recipientcountry"])


def both_sources(spark: SparkSession, landed: str, out: str, version: Version):
    """The tables of both sources with their key sets, each computed once, and the rows of every input."""
    first, first_rows = landing.first_source(spark, landed, out)
    second, second_rows = landing.second_source(spark, landed, out)
    first = landing.with_keys(first, version.add("first_keys", reconcile.first_keys(first, fixed.COUNTRY_CODE)))
    second = landing.with_keys(second, version.add("second_keys", reconcile.second_keys(second, fixed.COUNTRY_CODE)))
    rows = {f"first {n}": r for n, r in first_rows.items()} | {f"second {n}": r for n, r in second_rows.items()}
    return first, second, rows


#: What the comparisons cannot do without.
COMPARED = ["first act", "first country", "first trans", "second activity", "second recipientcountry"]


def reconcile_job(spark: SparkSession, landed: str, out: str) -> None:
    """Totals, years, largest activities and identifier sets of both sources."""
    version = Version(spark, f"{out}/reconciliation")
    first, second, rows = both_sources(spark, landed, out, version)
    version.add("total", reconcile.total_gap(first, second))
    version.add("total_check", reconcile.total_check(second))
    years = version.add("years", reconcile.year_gap(first, second), sorted_by=["year"])
    version.add("year_dispersion", reconcile.year_dispersion(years))
    spot = version.add("spot_check", reconcile.spot_check(first, second))
    version.add("spot_counts", reconcile.spot_counts(spot))
    sets = version.add("identifiers", reconcile.id_sets(first, second))
    version.add("identifier_verdict", reconcile.id_verdict(sets))
    ordered = positioned(reconcile.exclusive_value(first, second), reconcile.exclusive_order())
    value = version.add("only_first", ordered, sorted_by=["position"])
    version.add("only_first_total", reconcile.exclusive_total(value))
    version.add("only_second", reconcile.exclusive_second(first, second))
    shared = version.add("shared", reconcile.shared_gaps(first, second))
    version.add("shared_top", reconcile.shared_top(shared))
    version.add("shared_dispersion", reconcile.shared_dispersion(shared))
    version.commit(rows, required=COMPARED)


def tracker_job(spark: SparkSession, landed: str, out: str) -> None:
    """A dated snapshot of the activities that the second source lacks; versions are the history."""
    version = Version(spark, f"{out}/tracker")
    first, second, rows = both_sources(spark, landed, out, version)
    publish_tracker(version, reconcile.tracked(first, second))
    version.commit(rows, required=COMPARED)


def registry_job(spark: SparkSession, landed: str, out: str) -> None:
    """What the registry snapshot knows about the missing activities."""
    version = Version(spark, f"{out}/registry")
    first, second, rows = both_sources(spark, landed, out, version)
    registry = spark.read.schema(schemas.REGISTRY).parquet(f"{landed}/registry")
    status = positioned(reconcile.registry_status(first, second, registry), ["identifier"])
    status = version.add("status", status, sorted_by=["position"])
    version.add("counts", reconcile.registry_counts(status))
    version.commit(rows, required=COMPARED)


def releases_job(spark: SparkSession, landed: str, out: str) -> None:
    """Load the bulk files that have landed, then list the releases still to load.

    Files land as ``bulk/<reporter>_<period>.csv``; the manifest of loaded files, empty ones included, says
    which releases are loaded.
    """
    base = f"{out}/releases"
    incremental.load_landed(spark, f"{landed}/bulk", schemas.RECORDS, f"{base}/bulk")
    version = Version(spark, base)
    listed = releases.of_reporter(trade_files.read_releases(spark, f"{landed}/releases"))
    loaded = version.add("loaded", releases.loaded_releases(listed, incremental.manifest(spark, f"{base}/bulk")))
    waiting = with_constants(releases.pending(listed, loaded), found_on=F.current_date())
    version.add("pending", positioned(waiting, [releases.newest(), "reporterCode"]), sorted_by=["position"])
    version.commit()


JOBS = {
    "aid": aid_job, "counts": counts_job, "trade": trade_job, "comparison": comparison_job,
    "reconcile": reconcile_job, "tracker": tracker_job, "registry": registry_job, "releases": releases_job,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=f"Jobs over landed files, country {fixed.COUNTRY_CODE}.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--landed", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    chosen = parser.parse_args(arguments)
    spark = build_session(f"ledgerloom-{chosen.job}", shuffle_partitions=chosen.shuffle_partitions)
    JOBS[chosen.job](spark, chosen.landed, chosen.out)


if __name__ == "__main__":
    main()
