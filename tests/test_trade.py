import pytest

from paths import FIXTURES
from ledgerloom import fixed_values as fixed
from ledgerloom.plans import releases, trade
from ledgerloom.sources import rates, sdmx, trade_files


@pytest.fixture(scope="module")
def facts(spark):
    flat = sdmx.flatten_series(sdmx.read_series(spark, f"{FIXTURES}/trade"), keep=["flux", "section_code"])
    return trade.facts(flat, rates.fallback_rates(spark))


def test_facts_from_files(facts):
    assert facts.columns == [n for n, _, _ in fixed.triples(fixed.TRADE_COLUMNS)] and len(facts.columns) == 13
    got = [tuple(r)[:10] for r in trade.in_published_order(facts).collect()]
    eur = round(100000.0 / 1.1422, 2)
    fuel = round(7250.0 / 1.1195, 2)
    assert got == [
        (1997, "Export", "06-15_Vegetable", "Produits vegetaux - vanille, girofle (ch.06-15)", "FRA", "France",
         12500.0, None, None, None),
        (2020, "Export", "06-15_Vegetable", "Produits vegetaux - vanille, girofle (ch.06-15)", "FRA", "France",
         100000.0, eur, round(eur * 491.968, 0), 1.1422),
        (2019, "Import", "27-27_Fuels", "Combustibles, hydrocarbures (ch.27)", "ZZZ", "ZZZ",
         7250.0, fuel, round(fuel * 491.968, 0), 1.1195),
    ]
    row = facts.first()
    assert (row["reporter_code"], row["reporter_pays"]) == ("COM", "Union des Comores") and len(row["date_extraction"]) == 10


def test_statistics(facts):
    row = trade.statistics(facts).first()
    assert tuple(row) == (3, 2, 1, 2, 2, 1997, 2020)


def test_flows_that_landed_apart(spark):
    def flow(code, section):
        path = f"{FIXTURES}/trade/flux={code}/section_code={section}"
        flat = sdmx.flatten_series(sdmx.read_series(spark, path))
        return flat.selectExpr("*", f"'{code}' AS flux", f"'{section}' AS section_code")

    both = trade.both_flows(flow("X", "06-15_Vegetable"), flow("M", "27-27_Fuels"))
    assert trade.facts(both, rates.fallback_rates(spark)).count() == 3


def test_unreadable_value_stops_the_job(spark):
    bad = spark.createDataFrame([("X", "s", "FRA", "2020", "1,5")],
                                "flux string, section_code string, PARTNER string, TIME_PERIOD string, OBS_VALUE string")
    with pytest.raises(Exception, match="unreadable value"):
        trade.facts(bad, rates.fallback_rates(spark)).collect()


def test_releases(spark):
    listed = trade_files.read_releases(spark, f"{FIXTURES}/releases.json")
    mine = releases.of_reporter(listed)
    assert [r["fileUrl"] for r in releases.latest_first(mine).collect()][-1] == "u3"   # no period sorts last
    loaded = spark.createDataFrame([(174, "2020")], "reporterCode int, period string")
    waiting = releases.latest_first(releases.pending(mine, loaded)).collect()
    assert [(r["period"], r["fileUrl"]) for r in waiting] == [("2021", "u2"), ("2019", "u5"), (None, "u3")]
    done = spark.createDataFrame([(174, p) for p in ("2019", "2020", "2021", None)], "reporterCode int, period string")
    assert releases.pending(mine, done).count() == 0


def test_availability(spark):
    records = spark.createDataFrame([(174, "2021"), (174, "2021"), (250, "2022")], "reporterCode int, period string")
    got = {(r["reporterCode"], r["period"]): (r["n_records"], r["has_data"]) for r in
           releases.availability(records, ["2021", "2022"]).collect()}
    assert got == {(174, "2021"): (2, True), (174, "2022"): (0, False), (250, "2021"): (0, False), (250, "2022"): (1, True)}
    listing = trade_files.read_availability(spark, f"{FIXTURES}/availability.json")
    assert [r["period"] for r in releases.available_periods(listing).collect()] == ["2019", "2021"]


def test_code_search(spark):
    codes = trade_files.read_code_list(spark, f"{FIXTURES}/codes.json")
    assert sorted(r["id"] for r in releases.search_codes(codes, prefix="09").collect()) == ["09", "0905"]
    assert [r["id"] for r in releases.search_codes(codes, contains="COMORO").collect()] == ["174"]
