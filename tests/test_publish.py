import pytest
from pyspark.sql import functions as F

from paths import FIXTURES
from ledgerloom import fixed_values as fixed
from ledgerloom.plans import aid, reconcile, second_source, trade
from ledgerloom.sinks import publish, versions
from ledgerloom.sinks.versions import Version
from ledgerloom.sources import rates, sdmx
from ledgerloom.sources.audit import EmptyInput
from test_aid import tables  # noqa: F401
from test_reconcile import sides  # noqa: F401


def version(spark, base):
    return Version(spark, str(base))


def test_aid_is_published_with_its_dictionary(spark, tables, tmp_path):  # noqa: F811
    made = version(spark, tmp_path)
    publish.publish_aid(made, aid.dataset(tables))
    made.commit()
    stored = publish.read_published(spark, str(tmp_path))
    assert stored.columns == aid.PUBLISHED and stored.count() == 3
    assert stored.schema["statut"].metadata["comment"].startswith("Étape d'avancement")
    dictionary = publish.read_published(spark, str(tmp_path), "metadata")
    assert dictionary.columns == ["colonne", "source", "description"] and dictionary.count() == 24


def test_an_undocumented_column_is_refused(spark, tables, tmp_path):  # noqa: F811
    extra = aid.dataset(tables).withColumn("autre", F.lit(1))
    with pytest.raises(publish.UndocumentedColumn, match="autre"):
        publish.publish_aid(version(spark, tmp_path), extra)
    with pytest.raises(publish.UndocumentedColumn, match="titre"):
        publish.publish_aid(version(spark, tmp_path), aid.dataset(tables).drop("titre"))


def test_trade_is_partitioned_by_year_and_flow(spark, tmp_path):
    flat = sdmx.flatten_series(sdmx.read_series(spark, f"{FIXTURES}/trade"), keep=["flux", "section_code"])
    made = version(spark, tmp_path)
    publish.publish_trade(made, trade.facts(flat, rates.fallback_rates(spark)))
    made.commit()
    whole = publish.read_published(spark, str(tmp_path), ordered=True)
    assert whole.columns == trade.PUBLISHED and dict(whole.dtypes)["annee"] == "int"
    assert [(r["flux"], r["annee"]) for r in whole.collect()] == [("Export", 1997), ("Export", 2020), ("Import", 2019)]
    stored = publish.read_published(spark, str(tmp_path)).where("annee = 2020 AND flux = 'Export'")
    assert stored.count() == 1
    assert "PartitionFilters: [isnotnull(annee" in stored._jdf.queryExecution().executedPlan().toString()
    assert publish.read_published(spark, str(tmp_path), "metadata").count() == 13


def test_csv_is_readable(spark, tables, tmp_path):  # noqa: F811
    made = version(spark, tmp_path)
    written = publish.publish_aid(made, aid.dataset(tables), fmt="csv")
    made.commit()
    stored = publish.read_published(spark, str(tmp_path))
    assert stored.dtypes == written.dtypes == aid.dataset(tables).dtypes
    assert stored.columns == aid.PUBLISHED and stored.count() == 3


def test_comparison_and_its_notes(spark, sides, tmp_path):  # noqa: F811
    made = version(spark, tmp_path)
    publish.publish_comparison(made, second_source.dataset(sides[1]))
    made.commit()
    assert publish.read_published(spark, str(tmp_path), "comparison").columns == second_source.PUBLISHED
    notes = {r["point"]: r["valeur"] for r in publish.read_published(spark, str(tmp_path), "notes").collect()}
    assert len(notes) == 7 and len(notes["Date extraction"]) == 16


def test_tracker_snapshot(spark, sides, tmp_path):  # noqa: F811
    made = version(spark, tmp_path)
    publish.publish_tracker(made, reconcile.tracked(*sides))
    made.commit()
    read = {n: publish.read_published(spark, str(tmp_path), n) for n in ("activities", "missing", "by_publisher", "summary")}
    assert {n: df.count() for n, df in read.items()} == {"activities": 5, "missing": 3, "by_publisher": 1, "summary": 7}
    days = [r[0] for r in read["activities"].select("run_date").distinct().collect()]
    assert len(days) == 1 and len(days[0]) == 10
    assert sorted(r["position"] for r in read["missing"].collect()) == [1, 2, 3]


# ------------------------------------------------------------------ versions

def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(versions.NoVersion):
        versions.read_version(spark, base, "b")
    first = version(spark, base)
    first.add("a", spark.range(3).selectExpr("id AS z", "cast(id AS decimal(10,2)) AS y", "id % 2 AS x"), partition_by=["z"])
    first.add("b", spark.range(5))
    first.commit()
    second = version(spark, base)
    second.add("a", spark.range(7))
    with pytest.raises(Exception, match="broken"):
        second.add("b", spark.range(1).select(F.raise_error(F.lit("broken")).alias("id")))
    a = versions.read_version(spark, base, "a")
    assert a.columns == ["z", "y", "x"] and [t for _, t in a.dtypes] == ["bigint", "decimal(10,2)", "bigint"]
    assert a.count() == 3 and versions.read_version(spark, base, "b").count() == 5
    third = version(spark, base)
    third.add("a", spark.range(9))
    third.commit()
    assert versions.read_version(spark, base, "a").count() == 9
    with pytest.raises(versions.NoVersion):
        versions.read_version(spark, base, "b")


def test_a_reader_between_writes_sees_the_version_before(spark, tmp_path):
    for rows in (2, 4):
        made = version(spark, tmp_path)
        assert made.add("a", spark.range(rows)).count() == rows
        if rows == 4:
            assert versions.read_version(spark, str(tmp_path), "a").count() == 2
        made.commit({"input": rows}, required=["input"])
    run = {tuple(r) for r in versions.read_version(spark, str(tmp_path), "run").collect()}
    assert run == {("input", "input", 4), ("dataset", "a", 4)}


def test_an_empty_input_stops_before_the_pointer(spark, tmp_path):
    made = version(spark, tmp_path)
    made.add("a", spark.range(2))
    with pytest.raises(EmptyInput, match="lines: no rows"):
        made.commit({"lines": 0, "others": 0}, required=["lines"])
    assert versions.newest(spark, str(tmp_path)) == {}


def test_dictionaries_name_every_published_column():
    assert aid.PUBLISHED == [n for n, _, _ in fixed.triples(fixed.AID_COLUMNS)]
    assert trade.PUBLISHED == [n for n, _, _ in fixed.triples(fixed.TRADE_COLUMNS)]
