"""Reconciliation on two small publications that disagree on purpose."""

import pytest

from ledgerloom.plans import reconcile, second_source
from ledgerloom.plans.aid import AidTables
from ledgerloom.plans.second_source import SecondTables
from ledgerloom import schemas
from test_aid import rows_of


@pytest.fixture(scope="module")
def sides(spark):
    act = [dict(ord=i, aid=a, reporting=r, title=f"t{a}") for i, (a, r) in enumerate(
        [("1", "P"), ("2", "P"), ("3", "Q"), ("4", None), ("5", "Q"), ("6", "Q")])]
    country = [dict(ord=i, aid=a, country_code="KM", country_percent=p) for i, (a, p) in enumerate(
        [("1", "100"), ("2", None), ("3", "100"), ("4", "100"), ("5", "60"), ("6", "100"), ("1", "100")])]
    trans = [
        dict(ord=1, aid="1", trans_day="20190101", trans_usd="200000", trans_code="D"),
        dict(ord=2, aid="1", trans_day="20200101", trans_usd="100", trans_code="E"),
        dict(ord=3, aid="2", trans_day="20200301", trans_usd="50", trans_code="D"),
        dict(ord=4, aid="3", trans_day=None, trans_usd="25", trans_code="D"),
        dict(ord=5, aid="3", trans_day="20200301", trans_usd="1000", trans_code="C"),
        dict(ord=6, aid="5", trans_day="20200301", trans_usd="77", trans_code="D"),
    ]
    none = {n: rows_of(spark, s, []) for n, s in [
        ("translation", schemas.ACT_TRANSLATION), ("sector", schemas.SECTOR), ("budget", schemas.BUDGET),
        ("location", schemas.LOCATION)]}
    first = AidTables(
        rows_of(spark, schemas.ACT, act), none["translation"], rows_of(spark, schemas.COUNTRY, country),
        none["sector"], none["budget"], rows_of(spark, schemas.TRANS, trans), none["location"])

    activity = [dict(_link=l, iatiidentifier=i, reportingorg_narrative=r, activitystatus_codename=s) for l, i, r, s in [
        ("L1", " 1 ", "P", "Closed"), ("L2", "2", "P", "Closed"), ("L7", "EXT", "X", None), ("L8", None, "Y", "Open"),
        ("L5", "5", "Q", "Open")]]
    recipient = [dict(_link_activity=l, code=c, percentage=p) for l, c, p in [
        ("L1", "KM", "100"), ("L2", "KM", None), ("L7", "KM", "99"), ("L8", "KM", "100"),
        ("L5", "KM", "60"), ("L5", "KM", "40")]]
    breakdown = [dict(_link_activity=l, iatiidentifier=i, transactiontype_code=t, transactiondate_isodate=d,
                      value_usd=v, recipientcountry_code=c) for l, i, t, d, v, c in [
        ("L1", " 1 ", "3", "2019-02-01", "150000", "KM"), ("L1", " 1 ", "4", "2020-02-01", "90", "KM"),
        ("L1", " 1 ", "3", "2020-02-01", "5000", "MG"), ("L1", " 1 ", "2", "2020-02-01", "5000", "KM"),
        ("L2", "2", "3", "2020-05-01", "60", "KM"), ("L2", "2", "3", None, "1", "KM"),
        ("L7", "EXT", "3", "2021-05-01", "500", "KM"), ("L8", None, "3", "2021-05-01", "400", "KM"),
        ("L5", "5", "3", "2021-05-01", "12345", "KM")]]
    budget = [dict(_link_activity="L2", value="10", value_currency="EUR", iatiidentifier="2"),
              dict(_link_activity="L2", value="bad", value_currency="USD", iatiidentifier="2"),
              dict(_link_activity="L99", value="10", value_currency="EUR", iatiidentifier="9")]
    second = SecondTables(
        rows_of(spark, schemas.T_ACTIVITY, activity), rows_of(spark, schemas.T_RECIPIENT, recipient),
        rows_of(spark, schemas.T_BREAKDOWN, breakdown), rows_of(spark, schemas.T_BUDGET, budget))
    return first, second


def test_total_gap(sides):
    row = reconcile.total_gap(*sides).first()
    # a repeated country row does not count transactions twice
    assert (row["dp_usd"], row["dp_activities"]) == (200175.0, 3)
    assert row["it_usd"] == 150000 + 90 + 60 + 1 + 500 + 400
    assert row["gap_pct"] == pytest.approx((row["it_usd"] - 200175.0) / 200175.0 * 100)
    assert row["verdict"] == "significant"


def test_total_check(sides):
    row = reconcile.total_check(sides[1], reference_usd=150000).first()
    assert (row["n_activities"], row["it_usd"], row["verdict"]) == (3, 151051.0, "equivalent")


def test_year_gap(sides):
    years = reconcile.year_gap(*sides)
    got = {r["year"]: (r["it_usd"], r["dp_usd"], None if r["gap_pct"] is None else round(r["gap_pct"], 6), r["flagged"])
           for r in years.collect()}
    assert got == {"2019": (150000.0, 200000.0, -25.0, True), "2020": (150.0, 150.0, 0.0, False),
                   "2021": (900.0, 0.0, None, False)}
    spread = reconcile.year_dispersion(years).first()
    assert (spread["n_gaps"], spread["spread"], spread["verdict"]) == (1, None, "variable")
    none = reconcile.year_dispersion(years, floor=1e9).first()
    assert (none["n_gaps"], none["verdict"]) == (0, None)


def test_spot_check(sides):
    spot = reconcile.spot_check(*sides, n=4)
    got = [(r["identifier"], r["reporter"], r["it_usd"], r["dp_usd"], r["gap_text"]) for r in spot.collect()]
    assert got == [("1", "P", 150090.0, 200100.0, "-25.0%"), ("EXT", "X", 500.0, 0.0, "+100.0%"),
                   (None, "Y", 400.0, None, "N/A"), ("2", "P", 61.0, 50.0, "+22.0%")]
    row = reconcile.spot_counts(spot).first()
    assert (row["matched"], row["missing"], row["verdict"]) == (2, 1, "some_missing")


def test_identifier_sets(sides):
    sets = reconcile.id_sets(*sides)
    got = {r["identifier"]: (r["in_first"], r["in_second"]) for r in sets.collect()}
    assert got == {"1": (True, True), "2": (True, True), "3": (True, False), "4": (True, False), "6": (True, False),
                   "EXT": (False, True)}
    row = reconcile.id_verdict(sets).first()
    assert (row["in_both"], row["only_first"], row["only_second"], row["verdict"]) == (2, 3, 1, "both_diverge")


def test_exclusive_activities(sides):
    value = reconcile.exclusive_value(*sides)
    assert [tuple(r) for r in value.collect()] == [("3", 25.0)]
    assert tuple(reconcile.exclusive_total(value).first()) == (1, 25.0)
    assert [tuple(r) for r in reconcile.exclusive_second(*sides).collect()] == [("EXT", "X")]


def test_shared_gaps_match_amounts_without_blanks(sides):
    shared = reconcile.shared_gaps(*sides)
    got = [(r["iatiidentifier"], r["it_usd"], r["dp_usd"], r["flagged"]) for r in reconcile.shared_top(shared).collect()]
    assert got == [("1", 150090.0, 200100.0, True), ("2", 61.0, 50.0, True)]
    assert reconcile.shared_top(shared, n=1).count() == 1
    row = reconcile.shared_dispersion(shared).first()
    assert row["n_gaps"] == 2 and row["median_gap"] == pytest.approx((22 - 5001000 / 200100) / 2)


def test_missing_activities(sides):
    flagged = reconcile.tracked(*sides)
    detail = [(r["iati_identifier"], r["total_de_usd"]) for r in reconcile.missing_detail(flagged).collect()]
    assert detail == [("3", 25.0), ("4", 0.0), ("6", 0.0)]
    publishers = [tuple(r) for r in reconcile.missing_by_publisher(flagged).collect()]
    assert publishers == [("Q", 2, 25.0)]                       # no publisher, no line
    row = reconcile.missing_figures(flagged).first()
    assert (row["n_activities"], row["n_present"], row["n_missing"]) == (5, 2, 3)
    assert row["present_usd"] + row["missing_usd"] == row["all_usd"]
    assert row["gap_pct"] == round(25 / 200175 * 100, 2)
    metrics = {r["metric"]: r["value"] for r in reconcile.missing_summary(reconcile.missing_figures(flagged)).collect()}
    assert metrics["missing"] == "3" and metrics["missing_usd"] == "25.00" and len(metrics) == 7


def test_registry_status(spark, sides):
    registry = spark.createDataFrame([("3", 2, True), ("3", 1, True), ("4", None, True), ("6", 1, False)],
                                     "identifier string, occurrences int, checked boolean")
    status = reconcile.registry_status(*sides, registry)
    assert [tuple(r) for r in status.collect()] == [
        ("3", "found", 2, "Q"), ("4", "not_found", None, ""), ("6", "unanswered", None, "Q")]
    assert [tuple(r) for r in reconcile.registry_counts(status).collect()] == [
        ("found", 1), ("not_found", 1), ("unanswered", 1)]


def test_second_source_dataset(sides):
    published = second_source.dataset(sides[1])
    assert published.columns == second_source.PUBLISHED
    got = {(r["aid"], r["country_percent"]): r for r in published.collect()}
    # two shares of one activity stay two rows
    assert sorted(got, key=repr) == sorted(
        [(" 1 ", 100.0), ("2", 100.0), ("EXT", 99.0), (None, 100.0), ("5", 60.0), ("5", 40.0)], key=repr)
    assert got["2", 100.0]["montant_verse_usd_iati_tables"] == 61.0 and got["2", 100.0]["budget_raw_iati_tables"] == 10.0
    assert got["EXT", 99.0]["projet_multi_pays"] == "Oui" and got["EXT", 99.0]["budget_raw_iati_tables"] is None
    assert got[None, 100.0]["montant_verse_usd_iati_tables"] == 0.0
    by_status = {r["status_label"]: r["nb_activites"] for r in second_source.spend_by_status(published).collect()}
    assert by_status == {"Closed": 2, "Open": 3}
    split = {r["projet_multi_pays"]: r["n_activities"] for r in second_source.multi_country_split(published).collect()}
    assert split == {"Non": 3, "Oui": 3}
    total = second_source.spend_total(published).first()
    assert total["total_usd"] == 150090 + 61 + 500 + 12345      # the doubled activity counts once


def test_hot_activity_is_added_up_once(spark):
    """A third of all transactions in one activity, repeated country rows: same totals."""
    rows = [dict(ord=i, aid="hot" if i % 3 == 0 else f"a{i % 50}", trans_day="20200101", trans_usd="1", trans_code="D")
            for i in range(3000)]
    country = [dict(ord=i, aid="hot", country_code="KM", country_percent="100") for i in range(500)]
    country += [dict(ord=i, aid=f"a{i}", country_code="KM", country_percent="100") for i in range(50)]
    first = AidTables(*[rows_of(spark, schemas.ACT, [])] * 2, rows_of(spark, schemas.COUNTRY, country), None, None,
                      rows_of(spark, schemas.TRANS, rows), None)
    second = SecondTables(*[rows_of(spark, s, []) for s in (
        schemas.T_ACTIVITY, schemas.T_RECIPIENT, schemas.T_BREAKDOWN, schemas.T_BUDGET)])
    row = reconcile.total_gap(first, second).first()
    assert (row["dp_usd"], row["dp_activities"], row["it_usd"]) == (3000.0, 51, 0.0)
    years = reconcile.year_gap(first, second).collect()
    assert [(r["year"], r["dp_usd"]) for r in years] == [("2020", 3000.0)]
