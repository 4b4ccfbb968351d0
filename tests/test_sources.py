import pytest
from pyspark.sql import functions as F

from paths import FIXTURES
from ledgerloom import schemas
from ledgerloom.sources import audit, envelopes, rates, sdmx, trade_files
from ledgerloom.streaming import incremental


def test_object_table_keeps_arrival_order_over_pages(spark):
    rows = envelopes.read_object_table(spark, f"{FIXTURES}/act", schemas.ACT, on_error="skip").orderBy("ord").collect()
    assert [(r["aid"], r["status_code"], r["reporting"]) for r in rows] == [
        ("A1", "2", "Donor"), ("A2", "9", "Donor"), ("A3", "x", None)]
    assert [r["ord"] for r in rows] == [(1 << 32), (1 << 32) + 1, (2 << 32)]


def test_object_table_error_stops_the_job(spark):
    with pytest.raises(Exception, match="source error: time-out"):
        envelopes.read_object_table(spark, f"{FIXTURES}/act", schemas.ACT).collect()
    assert tuple(envelopes.error_pages(spark, f"{FIXTURES}/act").first()) == (3, 1)


@pytest.mark.parametrize("names", [
    ["part-00000-c000.json", "part-00001-c000.json"], ["answers.json", "more.json"],
    ["20260323104512.json", "20260323104513.json"], ["page_2.json", "page_10.json"], ["a/page_1.json", "b/page_1.json"],
])
def test_files_have_places_of_their_own(spark, tmp_path, names):
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text('{"rows": [{"aid": "%d"}, {"aid": "%dx"}]}' % (i, i))
    path = str(tmp_path / "*") if "/" in names[0] else str(tmp_path)
    rows = envelopes.read_object_table(spark, path, schemas.ACT).orderBy("ord").collect()
    assert [r["aid"] for r in rows] == ["0", "0x", "1", "1x"] and len({r["ord"] for r in rows}) == 4


def test_malformed_file_stops_the_job(spark, tmp_path):
    (tmp_path / "page_1.json").write_text('{"rows": [{"aid": ')
    with pytest.raises(Exception):
        envelopes.read_object_table(spark, str(tmp_path), schemas.ACT).collect()


def test_translated_table(spark):
    row = envelopes.read_translated_table(spark, f"{FIXTURES}/act_fr", schemas.ACT_TRANSLATION, "fr").first()
    assert (row["aid"], row["title"], row["description"]) == ("A1", "premier", None)


def test_array_table_finds_columns_by_name(spark):
    rows = envelopes.read_array_table(spark, f"{FIXTURES}/second", schemas.T_RECIPIENT).orderBy("_link_activity").collect()
    assert [tuple(r) for r in rows] == [
        ("L1", "KM", None), ("L2", "KM", None), ("L3", "KM", "99.5"), ("L4", None, None)]


def test_array_table_that_is_not_ok(spark):
    path = f"{FIXTURES}/second_error.json"
    with pytest.raises(Exception, match="source error: interrupted"):
        envelopes.read_array_table(spark, path, schemas.T_RECIPIENT).collect()
    empty = envelopes.read_array_table(spark, path, schemas.T_RECIPIENT, on_error="skip")
    assert empty.columns == schemas.T_RECIPIENT.names and empty.count() == 0


def test_series_are_flattened_whatever_the_prefix(spark):
    flat = sdmx.flatten_series(sdmx.read_series(spark, f"{FIXTURES}/trade"), keep=["flux", "section_code"])
    got = sorted(
        (r["flux"], r["section_code"], r["PARTNER"], r["TIME_PERIOD"], r["OBS_VALUE"] or "", r["FREQ"]) for r in flat.collect())
    assert got == [
        ("M", "27-27_Fuels", "ZZZ", "2019", "7.25", "A"), ("M", "27-27_Fuels", "ZZZ", "2020", "0", "A"),
        ("X", "06-15_Vegetable", "", "2020", "1", "A"),
        ("X", "06-15_Vegetable", "FRA", "1997", "12.5", "A"),   # the series wins over FREQ="Q"
        ("X", "06-15_Vegetable", "FRA", "2020", "100.0", "A"), ("X", "06-15_Vegetable", "FRA", "2021", "", "A"),
        ("X", "06-15_Vegetable", "WLD", "2020", "500", "A"),
    ]


def test_unreadable_section_is_seen_and_the_rest_is_read(spark):
    series = sdmx.read_series(spark, f"{FIXTURES}/broken", audit=True)
    got = {r["section_code"]: (r["n_series"], r["n_obs"], r["n_unreadable"]) for r in
           sdmx.section_audit(series, ["flux", "section_code"]).collect()}
    assert got["06-15_Vegetable"] == (3, 5, 0)
    assert got.get("27-27_Fuels", (0, 0, 1))[0] == 0
    good = sdmx.flatten_series(series.where("_corrupt_record IS NULL"), keep=["section_code"])
    assert good.count() == 5


def test_rates_skip_missing_observations(spark):
    got = sorted(tuple(r) for r in rates.read_rates(spark, f"{FIXTURES}/rates.json").collect())
    assert got == [(2020, 1.1422), (2022, 1.053)]


def test_rates_fall_back_as_a_whole(spark):
    fallback = rates.fallback_rates(spark)
    live = rates.read_rates(spark, f"{FIXTURES}/rates.json")
    assert rates.rates_or_fallback(live, fallback).count() == 2
    assert rates.rates_or_fallback(live.where("annee > 3000"), fallback).count() == 26
    bad = live.unionByName(spark.createDataFrame([(None, 1.0)], "annee int, taux double"))
    assert rates.rates_or_fallback(bad, fallback).count() == 26


def test_unreadable_rate_document_falls_back(spark, tmp_path):
    (tmp_path / "rates.json").write_text("<html>down for maintenance</html>")
    live = rates.read_rates(spark, str(tmp_path))
    assert rates.rates_or_fallback(live, rates.fallback_rates(spark)).count() == 26


def test_releases_codes_and_availability(spark):
    assert trade_files.read_releases(spark, f"{FIXTURES}/releases.json").count() == 6
    assert trade_files.read_code_list(spark, f"{FIXTURES}/codes.json").count() == 3
    assert [r["id"] for r in trade_files.read_code_list(spark, f"{FIXTURES}/codes.csv").collect()] == ["0905", "0907"]
    row = trade_files.read_availability(spark, f"{FIXTURES}/availability.json").orderBy("period").first()
    assert (row["period"], row["totalRecords"]) == ("2019", 90)


def test_bulk_files_and_selection(spark):
    records = trade_files.read_bulk(spark, f"{FIXTURES}/bulk.csv.gz")
    assert records.count() == 3
    picked = trade_files.select_records(records, period=["2021"], reporter=["174"], flow=["M", "X"])
    assert sorted(r["cmdCode"] for r in picked.collect()) == ["0905", "0907"]
    assert trade_files.select_records(records, commodity=["0905"], max_records=1, order=["period"]).count() == 1
    with pytest.raises(ValueError, match="order"):
        trade_files.select_records(records, max_records=1)


def test_selection_prunes_partition_folders(spark, tmp_path):
    records = trade_files.read_bulk(spark, f"{FIXTURES}/bulk.csv.gz")
    records.write.partitionBy("period", "flowCode").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    picked = trade_files.select_records(stored, period=["2021"], flow=["X"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "period" in filters and "flowCode" in filters
    assert picked.count() == 1


def test_row_counts_are_observed(spark):
    df, seen = audit.counted(spark.range(5), "input")
    df.write.format("noop").mode("overwrite").save()
    assert audit.require_rows(seen, "input") == 5
    empty, none = audit.counted(spark.range(0), "empty")
    empty.collect()
    with pytest.raises(ValueError, match="empty: no rows"):
        audit.require_rows(none, "empty")


def test_each_landed_file_is_loaded_once(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    (tmp_path / "landing").mkdir()
    schema = "period string, value double"
    schema = spark.createDataFrame([], schema).schema

    def land(name, value):
        (tmp_path / "landing" / name).write_text(f"period,value\n2021,{value}\n")

    def load():
        incremental.load_new_files(spark, landing, schema, out, "bulk", checkpoint)
        return sorted((r["source_file"], r["value"]) for r in spark.read.parquet(out).collect())

    land("com_2020.csv", 1.0)
    assert load() == [("com_2020.csv", 1.0)]
    assert load() == [("com_2020.csv", 1.0)]
    land("com_2021.csv", 2.0)
    assert load() == [("com_2020.csv", 1.0), ("com_2021.csv", 2.0)]


def test_incremental_load_needs_a_shared_folder(spark, tmp_path):
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a folder")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        incremental.load_new_files(spark, str(tmp_path), spark.range(1).schema, str(tmp_path / "o"), "x")
