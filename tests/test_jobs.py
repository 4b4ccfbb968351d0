"""Each job from a landing folder to its published datasets."""

import json
import shutil

import pyarrow.parquet as pq
import pytest

from paths import FIXTURES
from ledgerloom import jobs, landing, schemas
from ledgerloom.plans import aid
from ledgerloom.sinks import versions
from ledgerloom.sinks.publish import read_published
from ledgerloom.sources import envelopes
from ledgerloom.sources.audit import EmptyInput
from ledgerloom.streaming import incremental


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")

    def land(path, document):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps(document))

    def objects(table, *rows):
        land(f"first/{table}/page_1.json", {"rows": list(rows)})

    def arrays(table, columns, *rows):
        land(f"second/{table}/page_1.json", {"ok": True, "columns": columns, "rows": [list(r) for r in rows]})

    objects("act",
            dict(aid="1", reporting="World Bank", reporting_ref="44000", title="one", status_code=2, day_start=19000),
            dict(aid="2", reporting="Agence", reporting_ref="FR-3", title="two", status_code=4))
    objects("country", dict(aid="1", country_code="KM", country_percent=100), dict(aid="2", country_code="KM"))
    objects("sector", dict(aid="1", sector_code="12110", sector_group="121"))
    objects("budget", dict(aid="1", budget_value=5, budget_currency="USD", budget_usd=5, budget_eur=4))
    objects("trans",
            dict(aid="1", trans_day=20200101, trans_usd=100.5, trans_eur=90, trans_code="D", trans_finance_code=110),
            dict(aid="2", trans_day=20210101, trans_usd=50, trans_eur=45, trans_code="E"),
            dict(aid="2", trans_day=20210101, trans_usd=7, trans_eur=6, trans_code="C"))
    objects("location", dict(aid="1", location_name="Moroni", location_latitude=-11.7, location_longitude=43.2))
    land("first/act_translated/lang=fr/page_1.json", {"rows": [dict(aid="1", title="un")]})
    arrays("activity", ["_link", "iatiidentifier", "activitystatus_codename"], ("L1", "1 ", "Closed"), ("L9", "9", None))
    arrays("recipientcountry", ["_link_activity", "code", "percentage"], ("L1", "KM", 100), ("L9", "KM", None))
    arrays("transaction_breakdown",
           ["_link_activity", "iatiidentifier", "transactiontype_code", "transactiondate_isodate", "value_usd",
            "recipientcountry_code"],
           ("L1", "1 ", "3", "2020-01-01", 99.5, "KM"))
    arrays("budget", ["_link_activity", "value", "iatiidentifier"], ("L1", 10, "1 "))
    shutil.copytree(f"{FIXTURES}/trade", root / "trade")
    (root / "rates").mkdir()
    shutil.copy(f"{FIXTURES}/rates.json", root / "rates")
    (root / "releases").mkdir()
    shutil.copy(f"{FIXTURES}/releases.json", root / "releases")
    return root


def test_aid_job(spark, landed, tmp_path):
    jobs.aid_job(spark, str(landed), str(tmp_path))
    rows = {r["id_projet"]: r for r in read_published(spark, f"{tmp_path}/aid").collect()}
    assert rows["1"]["titre"] == "un" and rows["1"]["instrument_financement"] == "Don"
    assert rows["1"]["montant_verse_usd"] == 100.5 and rows["2"]["pays_bailleur"] == "France"
    totals = read_published(spark, f"{tmp_path}/aid", "donor_totals").first()
    assert totals["total_usd"] == 150.5
    assert read_published(spark, f"{tmp_path}/aid", "donor_report").count() == 3


def test_counts_job(spark, landed, tmp_path):
    jobs.counts_job(spark, str(landed), str(tmp_path))
    assert read_published(spark, f"{tmp_path}/counts", "sector").first()["n_activities"] == 1
    assert read_published(spark, f"{tmp_path}/counts", "commitments").first()["commitment_usd"] == 7.0


def test_trade_job(spark, landed, tmp_path):
    jobs.trade_job(spark, str(landed), str(tmp_path))
    facts = read_published(spark, f"{tmp_path}/trade")
    assert {(r["annee"], r["taux_usd_eur"]) for r in facts.collect()} == {(1997, None), (2020, 1.1422), (2019, None)}
    assert read_published(spark, f"{tmp_path}/trade", "statistics").first()["n_total"] == 3
    audit = read_published(spark, f"{tmp_path}/trade", "audit")
    assert audit.count() == 32 and audit.where("n_series > 0").count() == 2
    assert audit.where("n_series = 0 AND n_obs = 0 AND n_unreadable = 0").count() == 30


def test_second_source_jobs(spark, landed, tmp_path):
    jobs.comparison_job(spark, str(landed), str(tmp_path))
    assert read_published(spark, f"{tmp_path}/second_source", "total").first()["total_usd"] == 99.5
    jobs.reconcile_job(spark, str(landed), str(tmp_path))
    verdict = read_published(spark, f"{tmp_path}/reconciliation", "identifier_verdict").first()
    assert (verdict["in_both"], verdict["only_first"], verdict["only_second"]) == (1, 1, 1)
    assert read_published(spark, f"{tmp_path}/reconciliation", "total").first()["gap_usd"] == 99.5 - 150.5
    jobs.tracker_job(spark, str(landed), str(tmp_path))
    assert read_published(spark, f"{tmp_path}/tracker", "missing").count() == 1


def test_registry_and_releases_jobs(spark, landed, tmp_path):
    spark.createDataFrame([("2", 1, True)], "identifier string, occurrences int, checked boolean").write.parquet(
        str(landed / "registry"))
    jobs.registry_job(spark, str(landed), str(tmp_path))
    assert [r["registry_status"] for r in read_published(spark, f"{tmp_path}/registry", "status").collect()] == ["found"]
    header = "period,reporterCode,cmdCode,flowCode,primaryValue\n"
    (landed / "bulk").mkdir()
    (landed / "bulk" / "174_2021.csv").write_text(header + "2021,174,0905,X,10\n")
    jobs.releases_job(spark, str(landed), str(tmp_path))
    periods = lambda name: {r["period"] for r in read_published(spark, f"{tmp_path}/releases", name).collect()}
    assert periods("pending") == {"2020", "2019", None} and periods("loaded") == {"2021"}
    for period in ("2020", "2019"):
        (landed / "bulk" / f"174_{period}.csv").write_text(header + f"{period},174,0907,M,5\n")
    jobs.releases_job(spark, str(landed), str(tmp_path))
    assert periods("pending") == {None} and periods("loaded") == {"2019", "2020", "2021"}
    jobs.releases_job(spark, str(landed), str(tmp_path))
    assert incremental.records(spark, f"{tmp_path}/releases/bulk", schemas.RECORDS).count() == 3


# ------------------------------------------------------------------ landed once

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """The plans of everything that jobs write."""
    plans = []

    def noted(write):
        def run(df, *arguments, **options):
            plans.append(plan_of(df))
            return write(df, *arguments, **options)
        return run

    monkeypatch.setattr(versions, "write", noted(versions.write))
    monkeypatch.setattr(landing, "write_in_buckets", noted(landing.write_in_buckets))
    return plans


def raw_scans(plans):
    return sum(p.count("Scan json") for p in plans)


def test_each_raw_table_is_parsed_once_and_each_key_set_made_once(spark, landed, tmp_path, written):
    jobs.reconcile_job(spark, str(landed), str(tmp_path))
    assert raw_scans(written) == 11  # seven tables of the first source, four of the second
    own = [p for p in written if "Scan json" not in p]
    assert sum("country_percent" in p for p in own) == 1 and sum("percentage#" in p for p in own) == 1
    del written[:]
    jobs.counts_job(spark, str(landed), str(tmp_path))
    jobs.tracker_job(spark, str(landed), str(tmp_path))
    assert written and raw_scans(written) == 0


def test_key_look_ups_skip_row_groups(spark, tmp_path):
    """Rows are sorted by key in their files, and a small set of keys reads the row groups that can hold them."""
    spark.conf.set("parquet.block.size", str(1 << 14))
    try:
        df = spark.range(200_000).selectExpr("cast(id * 7919 % 200000 AS string) AS aid", "id AS ord", "cast(id AS string) AS title")
        landing.write_in_buckets(df, f"{tmp_path}/t", "aid", ["ord"], 2)
    finally:
        spark.conf.unset("parquet.block.size")
    table = landing.open_in_buckets(spark, f"{tmp_path}/t", df.schema, "aid", ["ord"], 2)
    files = [pq.ParquetFile(p) for p in (tmp_path / "t").glob("*.parquet")]
    groups = [f.metadata.row_group(i).column(0).statistics for f in files for i in range(f.metadata.num_row_groups)]
    assert len(groups) > 20
    assert sum(g.min <= "4711" <= g.max for g in groups) <= 2
    found = table.where("aid = '4711'")
    assert found.count() == 1 and "PushedFilters: [IsNotNull(aid), EqualTo(aid,4711)]" in plan_of(found)
    assert all(f.read_row_group(0, columns=["aid"])["aid"].to_pylist() == sorted(f.read_row_group(0, columns=["aid"])["aid"].to_pylist()) for f in files)


def test_a_changed_file_lands_again(spark, landed, tmp_path):
    root = tmp_path / "landed"
    shutil.copytree(landed / "first", root / "first")
    base = f"{tmp_path}/typed"
    parse = lambda: envelopes.read_object_table(spark, f"{root}/first/budget", schemas.BUDGET)
    land = lambda: landing.land_table(spark, f"{root}/first/budget", base, parse, "aid", ("budget_usd",), 2)
    assert land().rows == 1 and land().table.first()["budget_usd"] == 5.0
    number = max(r["version"] for r in versions.newest(spark, base).values())
    land()
    assert max(r["version"] for r in versions.newest(spark, base).values()) == number
    (root / "first/budget/page_2.json").write_text(json.dumps({"rows": [{"aid": "7", "budget_usd": "x"}, {"aid": "8"}]}))
    again = land()
    assert again.rows == 3 and {(r["aid"], r["budget_usd"]) for r in again.table.collect()} == {("1", 5.0), ("7", None), ("8", None)}


def test_a_parse_error_keeps_what_landed_before(spark, landed, tmp_path):
    root = tmp_path / "landed"
    shutil.copytree(landed / "first", root / "first")
    base = f"{tmp_path}/typed"
    parse = lambda: envelopes.read_object_table(spark, f"{root}/first/budget", schemas.BUDGET)
    landing.land_table(spark, f"{root}/first/budget", base, parse, "aid", (), 2)
    (root / "first/budget/page_2.json").write_text('{"rows": [{"aid": ')
    with pytest.raises(Exception):
        landing.land_table(spark, f"{root}/first/budget", base, parse, "aid", (), 2)
    assert versions.read_version(spark, base, "rows").count() == 1


def big_source(root, activities=2000):
    def land(table, rows):
        (root / "first" / table).mkdir(parents=True)
        for page in range(3):
            part = [r for i, r in enumerate(rows) if i % 3 == page]
            (root / "first" / table / f"page_{page}.json").write_text(json.dumps({"rows": part}))

    ids = [f"A{i}" for i in range(activities)]
    land("act", [dict(aid=a, reporting="World Bank", reporting_ref="44000", title=a, status_code=2) for a in ids])
    land("country", [dict(aid=a, country_code="KM", country_percent=100) for a in ids])
    land("sector", [dict(aid=a, sector_code="12110", sector_group="121") for a in ids])
    land("budget", [dict(aid=a, budget_value=1, budget_currency="USD", budget_usd=1, budget_eur=1) for a in ids])
    land("trans", [dict(aid=a, trans_day=20200101, trans_usd=i, trans_eur=i, trans_code="D") for a in ids for i in range(3)])
    land("location", [dict(aid=a, location_name=f"place {a}", location_latitude=1, location_longitude=2) for a in ids])
    (root / "first/act_translated/lang=fr").mkdir(parents=True)
    (root / "first/act_translated/lang=fr/page_1.json").write_text(json.dumps({"rows": [{"aid": "A1", "title": "un"}]}))


def test_children_in_buckets_need_no_exchange(spark, tmp_path):
    big_source(tmp_path / "raw")
    tables, rows = landing.first_source(spark, str(tmp_path / "raw"), str(tmp_path))
    assert rows["trans"] == 6000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8192")  # code lists are smaller, the tables are not
    try:
        for child in (aid.sectors_per_activity(tables.sector), aid.budgets_per_activity(tables.budget),
                      aid.transactions_per_activity(tables.trans), aid.conditional_spend(tables.trans)):
            assert "hashpartitioning(aid" not in plan_of(child)
        star = aid.dataset(tables)
        assert "hashpartitioning(aid" not in plan_of(star)
        assert star.count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_an_uneven_table_is_opened_without_buckets(spark, landed, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "SMALL_BUCKET", 1)
    rows = [{"aid": "hot"}] * 60 + [{"aid": f"A{i}"} for i in range(10)]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/page_1.json").write_text(json.dumps({"rows": rows}))
    parse = lambda: envelopes.read_object_table(spark, f"{tmp_path}/raw", schemas.BUDGET)
    found = landing.land_table(spark, f"{tmp_path}/raw", f"{tmp_path}/typed", parse, "aid", (), 32)
    assert found.rows == 70 and found.table.count() == 70
    assert "Bucketed: true" not in plan_of(found.table.groupBy("aid").count())


def test_landed_tables_open_in_a_session_that_did_not_write_them(spark, tmp_path):
    big_source(tmp_path / "raw", 20)
    landing.first_source(spark, str(tmp_path / "raw"), str(tmp_path))
    for row in spark.sql("SHOW TABLES").collect():
        spark.sql(f"DROP TABLE {row['tableName']}")
    tables, _ = landing.first_source(spark, str(tmp_path / "raw"), str(tmp_path))
    assert tables.trans.count() == 60 and "Bucketed: true" in plan_of(tables.trans.groupBy("aid").count())


# ------------------------------------------------------------------ inputs that are empty, sections that are broken

def test_an_empty_child_table_stops_the_job(spark, landed, tmp_path):
    root = tmp_path / "landed"
    shutil.copytree(landed / "first", root / "first")
    jobs.aid_job(spark, str(root), str(tmp_path))
    before = versions.newest(spark, f"{tmp_path}/aid")["data"]["version"]
    (root / "first/budget/page_1.json").write_text('{"rows": []}')
    with pytest.raises(EmptyInput, match="budget: no rows"):
        jobs.aid_job(spark, str(root), str(tmp_path))
    assert versions.newest(spark, f"{tmp_path}/aid")["data"]["version"] == before
    run = {(r["kind"], r["name"]): r["rows"] for r in read_published(spark, f"{tmp_path}/aid", "run").collect()}
    assert run["input", "budget"] == 1 and run["dataset", "data"] == 2


def test_broken_section_is_kept_whole_and_replaced_alone(spark, landed, tmp_path):
    root = tmp_path / "raw"
    shutil.copytree(f"{FIXTURES}/broken", root)
    base = f"{tmp_path}/typed"
    series = landing.land_series(spark, str(root), base)
    lost = series.unreadable.collect()
    assert {(r["flux"], r["section_code"]) for r in lost} == {("M", "27-27_Fuels")}
    broken = (root / "flux=M/section_code=27-27_Fuels/part.xml").read_text()
    assert "".join(r["record"] for r in lost).strip() in broken or broken.strip() in "".join(r["record"] for r in lost)
    assert all(r["file"].endswith("part.xml") for r in lost)
    assert series.observations.count() == 5
    lines = {r["section_code"]: r["n_unreadable"] for r in series.sections.collect()}
    assert lines["27-27_Fuels"] >= 1 and lines["06-15_Vegetable"] == 0

    def stamps(name):
        folder = tmp_path / "typed" / name
        return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    before = {n: stamps(n) for n in ("observations", "unreadable", "sections")}
    shutil.copy(f"{FIXTURES}/trade/flux=M/section_code=27-27_Fuels/part.xml", root / "flux=M/section_code=27-27_Fuels/part.xml")
    series = landing.land_series(spark, str(root), base)
    assert series.unreadable.count() == 0 and series.observations.count() == 7
    assert {r["section_code"]: r["n_unreadable"] for r in series.sections.collect()} == {"27-27_Fuels": 0, "06-15_Vegetable": 0}
    for name, old in before.items():
        changed = {p.split("/")[1] for p, t in stamps(name).items() if old.get(p) != t}
        assert changed <= {"section_code=27-27_Fuels"}, name
    again = {n: stamps(n) for n in before}
    landing.land_series(spark, str(root), base)
    assert {n: stamps(n) for n in before} == again


# ------------------------------------------------------------------ the manifest of bulk files

def test_manifest_counts_files_without_rows_and_outlives_a_crash(spark, tmp_path, monkeypatch):
    landing_folder, base = tmp_path / "bulk", str(tmp_path / "out")
    landing_folder.mkdir()
    header = "period,reporterCode,cmdCode,flowCode,primaryValue\n"
    (landing_folder / "174_2019.csv").write_text(header)
    (landing_folder / "174_2020.csv").write_text(header + "2020,174,0905,X,1\n2020,174,0907,X,2\n")
    load = lambda: incremental.load_landed(spark, str(landing_folder), schemas.RECORDS, base)
    files = lambda: {(r["batch"], r["file_name"], r["rows"]) for r in incremental.manifest(spark, base).collect()}
    assert load() == 1 and files() == {(1, "174_2019.csv", 0), (1, "174_2020.csv", 2)}
    assert load() == 0 and incremental.records(spark, base, schemas.RECORDS).count() == 2

    (landing_folder / "174 2021.csv").write_text(header + "2021,174,0905,X,3\n")
    monkeypatch.setattr(incremental.F, "element_at", lambda *a: 1 / 0)  # after the rows, before the list
    with pytest.raises(ZeroDivisionError):
        load()
    monkeypatch.undo()
    assert incremental.records(spark, base, schemas.RECORDS).count() == 2  # the batch is not whole
    assert load() == 1 and incremental.records(spark, base, schemas.RECORDS).count() == 3
    assert len(files()) == 3 and load() == 0


def test_batches_hold_so_many_files_at_most(spark, tmp_path):
    (tmp_path / "bulk").mkdir()
    for i in range(5):
        (tmp_path / "bulk" / f"174_{i}.csv").write_text(f"period,reporterCode,cmdCode,flowCode,primaryValue\n{i},174,1,X,1\n")
    assert incremental.load_landed(spark, str(tmp_path / "bulk"), schemas.RECORDS, str(tmp_path / "out"), most_files=2) == 3
    assert incremental.records(spark, str(tmp_path / "out"), schemas.RECORDS).count() == 5
