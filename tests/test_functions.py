import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import clean, gaps, money, rules


def one(values, schema, rows, column):
    return [r[0] for r in values(schema, rows, column)]


def test_number_reads_text_like_a_coercing_parser(values):
    rows = [("12",), (" 1.5 ",), ("1e3",), ("abc",), ("",), (None,), ("NaN",), ("12d",), ("3.5f",), ("-7",)]
    got = one(values, "x string", rows, clean.number(F.col("x")))
    assert got == [12.0, 1.5, 1000.0, None, None, None, None, None, None, -7.0]


def test_number_of_passes_numeric_columns_through(spark):
    df = spark.createDataFrame([(1.5, 2), (float("nan"), 3)], "a double, b int")
    got = df.select(clean.number_of(df, "a"), clean.number_of(df, "b")).collect()
    assert [tuple(r) for r in got] == [(1.5, 2.0), (None, 3.0)]


def test_stripped_takes_all_white_space(values):
    rows = [(" a ",), ("\t b\n",), (" c d　",), (None,), ("   ",)]
    assert one(values, "x string", rows, clean.stripped(F.col("x"))) == ["a", "b", "c d", None, ""]


def test_strict_values_stop_on_bad_text(values):
    column = clean.strict_number(F.col("x"), "value")
    assert one(values, "x string", [("1.5",), (None,)], column) == [1.5, None]
    with pytest.raises(Exception, match="unreadable value: abc"):
        one(values, "x string", [("abc",)], column)
    assert one(values, "x string", [(None,)], clean.strict_int(F.col("x"), "p", default=0)) == [0]


def test_day_text_and_years(values):
    rows = [(19000.0,), (0.0,), (None,), (-1.0,)]
    assert one(values, "x double", rows, clean.day_text(F.col("x"))) == [
        "2022-01-08", "1970-01-01", None, "1969-12-31"]
    assert one(values, "x int", [(20191231,), (None,)], clean.year_of_day(F.col("x"))) == ["2019", None]
    assert one(values, "x int", [(19000,)], clean.year_of_day(F.col("x"), "epoch_day")) == ["2022"]
    assert one(values, "x string", [("2019-05-06",)], clean.year_of_iso(F.col("x"))) == ["2019"]
    with pytest.raises(ValueError):
        clean.year_of_day(F.col("x"), "other")


def test_status_and_flag_and_url(values):
    got = values("c double, l string", [(2.0, "En cours"), (9.0, None), (None, None)],
                 clean.status_text(F.col("c"), F.col("l")))
    assert got == [("2_En cours",), (None,), (None,)]
    assert one(values, "x double", [(100.0,), (40.0,)], clean.multi_country_flag(F.col("x"))) == ["Non", "Oui"]
    assert one(values, "x string", [("A-1",), (None,)], clean.activity_url(F.col("x"))) == [
        "https://d-portal.org/ctrack.html?slug=A-1#view=act", None]


@pytest.mark.parametrize("value", [2.675, 2.665, 1.005, 0.125, 0.375, -2.675, 10.0, 1234567.885, 1e12 + 0.125, 0.0])
def test_round_cents_agrees_with_python(values, value):
    assert one(values, "x double", [(value,)], money.round_cents(F.col("x"))) == [round(value, 2)]


def test_trade_conversion_chain(values):
    usd = money.units_from_thousands(F.col("x"))
    eur = money.eur_from_usd(usd, F.col("r"))
    rows = [(1.234, 1.0658), (1.234, None), (1.234, 0.0)]
    got = values("x double, r double", rows, usd, eur, money.trade_kmf(eur))
    expected_eur = round(1234.0 / 1.0658, 2)
    assert got == [(1234.0, expected_eur, round(expected_eur * 491.968, 0)), (1234.0, None, None), (1234.0, None, None)]


def test_money_texts_round_half_to_even(values):
    got = values("x double", [(2.5,), (3.5,), (1234567.2,)], money.usd_text(F.col("x")),
                 money.eur_text(F.col("x")), money.kmf_text(F.col("x")))
    assert got == [("$2", "€2", "2 KMF"), ("$4", "€4", "4 KMF"), ("$1,234,567", "€1,234,567", "1,234,567 KMF")]


FUNDERS = [
    # reference, name, country by substring, country by word
    ("GB-GOV-1", "World Health Organization", "Multilatéral", "Multilatéral"),
    ("XM-DAC-41114", "Some agency", "Multilatéral", "Multilatéral"),
    ("xm-dac-41114", "Some agency", "Autre", "Autre"),            # the reference prefix minds case
    ("fr-3", "Ministère", "France", "France"),                    # the country prefix does not
    (" GB-1 ", "Department", "Royaume-Uni", "Royaume-Uni"),
    ("ZZ-1", "Oxfam Novib", "ONG", "ONG"),
    ("ZZ-1", "Aga Khan Foundation", "Multilatéral", "ONG"),       # "un" in "Foundation"
    ("US-1", "United States Agency", "Multilatéral", "États-Unis"),
    ("ZZ-1", "Red Cross", "ONG", "ONG"),
    ("ZZ-1", "Care ", "Autre", "ONG"),                            # the stripped name has no blank to match
    ("ZZ-1", "Care International", "ONG", "ONG"),
    (None, None, "Autre", "Autre"),
]


@pytest.mark.parametrize("match,position", [("substring", 2), ("word", 3)])
def test_funder_rules_in_order(values, match, position):
    rows = [f[:2] for f in FUNDERS]
    got = one(values, "r string, n string", rows, rules.funder_country(F.col("r"), F.col("n"), match))
    assert got == [f[position] for f in FUNDERS]


def test_funder_rules_equal_every_term_tried_in_turn(values):
    """The shortened term list finds what the full list finds."""
    from ledgerloom import fixed_values as fixed
    names = [t.upper() for t in fixed.words(fixed.MULTILATERAL_NAMES)] + ["nothing", "Agence", "Ministry 12"]
    got = one(values, "n string", [(n,) for n in names],
              rules.mentions(F.col("n"), fixed.words(fixed.MULTILATERAL_NAMES)))
    expected = [any(t.lower() in n.lower() for t in fixed.words(fixed.MULTILATERAL_NAMES)) for n in names]
    assert got == expected


def test_funder_type(values):
    rows = [("Multilatéral",), ("France",), ("ONG",), ("Autre",)]
    assert one(values, "x string", rows, rules.funder_type(F.col("x"))) == ["Multilatéral", "Bilatéral", "ONG", "Autre"]


def test_financing_instrument(values):
    rows = [("110",), ("421",), ("110, 421",), ("510",), ("",), (None,), ("422",), ("4210",)]
    got = one(values, "x string", rows, rules.financing_instrument(rules.code_tokens(F.col("x"))))
    assert got == ["Don", "Prêt", "Mixte", "Autre", "Inconnu", "Inconnu", "Don", "Autre"]


def test_code_label_text(values):
    rows = [("1, 2", "a, b"), ("1, 2", "a"), (None, "a"), ("1", None), ("", "")]
    got = one(values, "c string, l string", rows, rules.code_label_text(F.col("c"), F.col("l")))
    assert got == ["1_a, 2_b", "a", None, None, "_"]


def test_section_codes_and_flow(values):
    rows = [("06-15_Vegetable",), ("Food",), ("",), (None,)]
    assert one(values, "x string", rows, rules.is_section_code(F.col("x"))) == [True, False, False, False]
    assert one(values, "x string", [("X",), ("M",)], rules.flow_name(F.col("x"))) == ["Export", "Import"]


def test_gap_ladders(values):
    rows = [(1.9,), (-4.9,), (9.9,), (10.0,), (None,)]
    got = values("p double", rows, gaps.total_verdict(F.col("p")), gaps.check_verdict(F.col("p")))
    assert got == [("excellent", "equivalent"), ("good", "equivalent"), ("moderate", "freshness"),
                   ("significant", "investigate"), ("significant", "investigate")]


def test_gap_percent_and_flags(values):
    rows = [(110.0, 100.0), (1.0, 0.0), (200_000.0, 150_000.0), (None, 5.0)]
    got = values("a double, b double", rows, gaps.gap_percent(F.col("a"), F.col("b")))
    assert [None if g[0] is None else round(g[0], 6) for g in got] == [10.0, None, 33.333333, None]
    flags = values("p double, b double", [(11.0, 2e5), (11.0, 1e5), (10.0, 2e5), (None, 2e5)],
                   gaps.material_gap(F.col("p"), F.col("b")), gaps.exceeds(F.col("p"), 10.5))
    assert flags == [(True, True), (False, True), (False, False), (False, False)]


def test_spot_text(values):
    rows = [("a", 110.0, 100.0), ("a", 5.0, 0.0), (None, 5.0, None), ("", 5.0, None), ("a", 75.0, 100.0)]
    got = one(values, "i string, v double, o double", rows, gaps.spot_text(F.col("i"), F.col("v"), F.col("o")))
    assert got == ["+10.0%", "+100.0%", "N/A", "N/A", "-25.0%"]


def test_set_and_spread_verdicts(values):
    got = one(values, "a int, b int", [(0, 0), (0, 1), (1, 0), (2, 3)], gaps.set_verdict(F.col("a"), F.col("b")))
    assert got == ["identical", "second_has_more", "first_has_more", "both_diverge"]
    got = one(values, "s double, n int", [(None, 0), (4.9, 3), (5.0, 3), (None, 1)],
              gaps.spread_verdict(F.col("s"), F.col("n")))
    assert got == [None, "uniform", "variable", "variable"]
    assert one(values, "a double, b double", [(1.0, 3.0), (1.0, 0.0)],
               gaps.coverage_percent(F.col("a"), F.col("b"))) == [33.33, None]
