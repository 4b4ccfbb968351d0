"""The aid dataset on hand-written tables, one row per irregularity."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed, schemas
from ledgerloom.plans import aid, single_country
from ledgerloom.plans.aid import AidTables


def rows_of(spark, schema, rows):
    names = schema.names
    full = [tuple({**dict.fromkeys(names), **row}[n] for n in names) for row in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def tables(spark):
    act = [
        dict(ord=1, aid="A", reporting="World Bank", reporting_ref="44000", title="en A", description="d A",
             slug="a", status_code="2", day_start="19000", day_end=None),
        dict(ord=2, aid="B", reporting="Agence", reporting_ref="FR-3", title="en B", description="d B", status_code="9"),
        dict(ord=3, aid="C", reporting=None, reporting_ref=None, title="en C", slug="c", status_code="text"),
        dict(ord=4, aid="Z", reporting="Zero", title="zero share"),
        dict(ord=5, aid="N", reporting="Not here", title="other country"),
        dict(ord=6, aid="A", reporting="Copy", reporting_ref="XX", title="copy of A", status_code="4"),
    ]
    translation = [dict(ord=1, aid="A", title="fr A", description=None), dict(ord=2, aid="B", title=None, description="fr d B")]
    country = [
        dict(ord=1, aid="A", country_code="KM", country_percent="40"),
        dict(ord=2, aid="A", country_code="MG", country_percent="60"),
        dict(ord=3, aid="B", country_code="KM", country_percent=None),
        dict(ord=4, aid="C", country_code="KM", country_percent="n/a"),
        dict(ord=5, aid="Z", country_code="KM", country_percent="0"),
        dict(ord=6, aid="N", country_code="MG", country_percent="100"),
        dict(ord=7, aid="B", country_code="KM", country_percent="25"),
    ]
    sector = [
        dict(ord=2, aid="A", sector_code="12110", sector_group="121"),
        dict(ord=1, aid="A", sector_code="99999", sector_group="121"),
        dict(ord=3, aid="A", sector_code="99999", sector_group=None),
        dict(ord=4, aid="B", sector_code=None, sector_group=None),
    ]
    budget = [
        dict(ord=1, aid="A", budget_value="10", budget_currency="USD", budget_usd="10", budget_eur="9"),
        dict(ord=2, aid="A", budget_value="5", budget_currency="EUR", budget_usd="x", budget_eur="5"),
        dict(ord=3, aid="B", budget_value=None, budget_currency=None),
    ]
    trans = [
        dict(ord=1, aid="A", trans_day="20200101", trans_usd="100", trans_eur="90", trans_code="D", trans_flow_code="10", trans_finance_code="110"),
        dict(ord=2, aid="A", trans_day=None, trans_usd="50", trans_eur="45", trans_code="E", trans_flow_code="77", trans_finance_code="421"),
        dict(ord=3, aid="A", trans_day="20200102", trans_usd="7", trans_eur="6", trans_code="C"),
        dict(ord=4, aid="A", trans_day="20200103", trans_usd=None, trans_eur="bad", trans_code="D", trans_flow_code="10"),
        dict(ord=5, aid="B", trans_day="20210101", trans_usd="30", trans_eur="20", trans_code="E"),
        dict(ord=6, aid="N", trans_day="20210101", trans_usd="999", trans_eur="999", trans_code="D", trans_finance_code="110"),
    ]
    location = [
        dict(ord=1, aid="A", location_name="Moroni", location_latitude="-11.7", location_longitude="43.2"),
        dict(ord=2, aid="A", location_name="Moroni", location_latitude="-12.2", location_longitude="44.4"),
        dict(ord=3, aid="A", location_name=None, location_latitude="-11.7", location_longitude="43.2"),
    ]
    return AidTables(
        rows_of(spark, schemas.ACT, act), rows_of(spark, schemas.ACT_TRANSLATION, translation),
        rows_of(spark, schemas.COUNTRY, country), rows_of(spark, schemas.SECTOR, sector),
        rows_of(spark, schemas.BUDGET, budget), rows_of(spark, schemas.TRANS, trans),
        rows_of(spark, schemas.LOCATION, location),
    )


@pytest.fixture(scope="module")
def published(tables):
    df = aid.dataset(tables)
    return df.columns, {r["id_projet"]: r.asDict() for r in df.collect()}


def test_columns_are_the_documented_ones_in_order(published):
    assert published[0] == [n for n, _, _ in fixed.triples(fixed.AID_COLUMNS)] and len(published[0]) == 24


def test_one_row_per_activity_with_a_positive_share(published):
    assert sorted(published[1]) == ["A", "B", "C"]


def test_complete_activity(published):
    row = published[1]["A"]
    assert row["titre"] == "fr A" and row["description"] == "d A"
    assert row["lien_source"] == "https://d-portal.org/ctrack.html?slug=a#view=act"
    assert row["statut"] == "2_En cours" and row["date_debut"] == "2022-01-08" and row["date_fin"] is None
    assert (row["bailleur_de_fonds"], row["type_bailleur"], row["pays_bailleur"], row["region_bailleur"]) == (
        "World Bank", "Multilatéral", "Multilatéral", "Multilatéral")
    assert row["projet_multi_pays"] == "Oui" and row["instrument_financement"] == "Mixte"
    assert row["montant_verse_usd"] == pytest.approx(60.0)       # (100 + 50) x 40 %
    assert row["montant_verse_eur"] == pytest.approx(54.0)
    assert row["montant_verse_kmf"] == pytest.approx(54.0 * 491.96775)
    assert row["budget_prevu_usd"] == 10.0                       # not weighted, unreadable amount skipped
    assert row["budget_prevu_eur"] == 14.0
    assert row["budget_prevu_kmf"] == pytest.approx(14.0 * 491.96775)
    assert row["secteur_detail"] == "99999, Politique sanitaire et gestion administrative"
    assert row["secteur_principal"] == "Santé générale"
    assert (row["localisation"], row["latitudes"], row["longitudes"]) == ("Moroni", "-11.7, -12.2", "43.2, 44.4")


def test_sparse_activities(published):
    b, c = published[1]["B"], published[1]["C"]
    assert b["titre"] == "en B" and b["description"] == "fr d B" and b["lien_source"] is None
    assert b["statut"] is None and b["pays_bailleur"] == "France" and b["region_bailleur"] == "Europe"
    assert b["projet_multi_pays"] == "Non" and b["montant_verse_usd"] == 30.0    # the first share counts
    assert b["instrument_financement"] == "Inconnu"                 # transactions without finance codes
    assert b["secteur_detail"] == "" and b["budget_prevu_usd"] == 0.0 and b["localisation"] is None
    assert c["instrument_financement"] is None and c["montant_verse_usd"] is None   # no transactions at all
    assert c["budget_prevu_usd"] is None and c["type_bailleur"] == "Autre" and c["projet_multi_pays"] == "Non"


def test_prefilter_gives_the_same_dataset(tables):
    plain = sorted(map(tuple, aid.dataset(tables).collect()), key=repr)
    assert sorted(map(tuple, aid.dataset(tables, prefilter=True).collect()), key=repr) == plain


def test_wide_dataset_keeps_unpublished_measures(tables):
    row = aid.wide_dataset(tables).where("aid = 'A'").first()
    assert row["n_transactions"] == 4
    assert row["expenditure_usd"] == pytest.approx(20.0)
    assert row["commitment_usd"] == pytest.approx(2.8)
    assert row["budget_currency"] == "USD, EUR" and row["budget_value"] == 15.0


def test_donor_summary_counts_dated_spend_only(tables):
    summary = aid.donor_summary(tables)
    got = [(r["region_bailleur"], r["pays_bailleur"], r["type_bailleur"], round(r["total_usd"], 6), r["text_usd"])
           for r in summary.collect()]
    assert got == [("Multilatéral", "Multilatéral", "Multilatéral", 40.0, "$40"),
                   ("Europe", "France", "Bilatéral", 30.0, "$30")]
    totals = aid.donor_totals(summary).first()
    assert totals["total_usd"] == pytest.approx(70.0) and totals["total_eur"] == pytest.approx(56.0)


def test_donor_report_adds_up(tables):
    published = aid.dataset(tables)
    report = aid.donor_report(published, n=1)
    got = [(r["bailleur_de_fonds"], r["is_others"], r["nb_projets"], r["montant_verse_usd"]) for r in
           report.orderBy("position").collect()]
    assert got == [("World Bank", False, 1, 60.0), ("Autres", True, 2, 30.0)]
    totals = aid.report_totals(report, published).first()
    assert (totals["nb_projets"], totals["n_projets"], totals["n_bailleurs"], totals["total_usd"]) == (3, 3, 2, 90.0)


def keys(df):
    return sorted(r[0] for r in df.collect())


def test_the_meanings_of_single_country_differ(spark, tables):
    assert keys(single_country.by_full_share(tables.country)) == ["B", "C"]
    assert keys(single_country.by_full_or_missing_share(tables.country)) == ["B"]
    assert keys(single_country.by_sole_recipient(tables.country)) == ["C", "Z"]
    recipient = spark.createDataFrame([
        ("L1", "KM", "100"), ("L2", "KM", "99"), ("L3", "KM", "98"), ("L4", "KM", None), ("L5", "KM", "50"),
        ("L5", "KM", "50"), ("L6", "KM", "100"), ("L6", "MG", "0"), ("L7", "MG", "100"),
    ], "_link_activity string, code string, percentage string")
    assert keys(single_country.by_single_row(recipient)) == ["L1", "L2", "L4", "L6"]


def test_sql_counts_agree_with_key_functions(tables):
    counts = {r["status_code"]: r["n_activities"] for r in aid.status_counts(tables).collect()}
    assert counts == {"text": 1, None: 1}
    joined = tables.act.join(single_country.by_sole_recipient(tables.country), "aid", "left_semi")
    assert counts == {r["status_code"]: r["n"] for r in joined.groupBy("status_code").agg(
        F.count_distinct("aid").alias("n")).collect()}


def test_sector_count_and_commitments(tables):
    assert aid.sector_activity_count(tables, "12110").first()["n_activities"] == 0
    row = aid.commitment_total(tables).first()
    assert (row["commitment_usd"], row["n_activities"]) == (0.0, 0)


def test_empty_children_are_fine(spark, tables):
    empty = AidTables(
        tables.act, tables.translation.limit(0), tables.country, tables.sector.limit(0), tables.budget.limit(0),
        tables.trans.limit(0), tables.location.limit(0),
    )
    rows = aid.dataset(empty).collect()
    assert len(rows) == 3 and all(r["montant_verse_usd"] is None for r in rows)
