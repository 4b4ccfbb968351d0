"""Operators against brute force on small inputs with a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.operators import aggregates, dims, filters, joins, rank, select, sets


def hot_rows(n=600, seed=3):
    """Rows of which a third share one key, with repeated codes and nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        rows.append((key, i, rng.choice(["10", "20", "99", None]), rng.choice(["a", "b", None]), rng.random()))
    return rows


def first_seen(items):
    return list(dict.fromkeys(i for i in items if i is not None))


def test_ordered_lists_equal_brute_force(spark):
    rows = hot_rows()
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, ord bigint, flow string, kind string, v double").repartition(7)
    got = {r["k"]: r for r in aggregates.ordered_lists(
        df, "k", "ord", ["flow", "kind"],
        labels={"label": ("flow", dims.code_dim(spark, fixed.FLOW_TYPES))}, sums={"total": F.col("v")},
    ).collect()}
    names = dict(fixed.pairs(fixed.FLOW_TYPES))
    keys = {r[0] for r in rows}
    assert set(got) == keys
    for key in keys:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        assert got[key]["flow"] == first_seen(r[2] for r in mine)
        assert got[key]["kind"] == first_seen(r[3] for r in mine)
        assert got[key]["label"] == first_seen(names.get(r[2], r[2]) for r in mine)
        assert got[key]["total"] == pytest.approx(sum(r[4] for r in mine))


def test_ordered_lists_of_nulls_only_are_empty(spark):
    df = spark.createDataFrame([("a", 1, None, None)], "k string, ord bigint, flow string, v double")
    row = aggregates.ordered_lists(df, "k", "ord", ["flow"], sums={"total": F.col("v")}).first()
    assert row["flow"] == [] and row["total"] == 0
    assert spark.range(1).select(aggregates.joined_text(F.array().cast("array<string>"))).first()[0] == ""


def test_labels_become_distinct_after_mapping(spark):
    """Two codes with one label give two codes and one label."""
    dim = spark.createDataFrame([("1", "same"), ("2", "same")], "code string, label string")
    df = spark.createDataFrame([("a", 1, "1"), ("a", 2, "2"), ("a", 3, "x")], "k string, ord bigint, c string")
    row = aggregates.ordered_lists(df, "k", "ord", ["c"], labels={"l": ("c", dim)}).first()
    assert row["c"] == ["1", "2", "x"] and row["l"] == ["same", "x"]


def report(spark, rows, n=4):
    df = spark.createDataFrame(rows, "name string, nb bigint, usd double")
    got = aggregates.top_and_others(df, "name", ["nb", "usd"], "usd", n, "Autres").orderBy("position").collect()
    return [(r["position"], r["is_others"], r["name"], r["nb"], r["usd"]) for r in got]


def test_top_and_others(spark):
    rows = [("a", 1, 50.0), (None, 2, 90.0), ("Autres", 3, 70.0), ("c", 4, 60.0), ("d", 5, 10.0), ("e", 6, 5.0)]
    got = report(spark, rows)
    assert got == [
        (1, False, None, 2, 90.0), (2, False, "Autres", 3, 70.0), (3, False, "c", 4, 60.0), (4, False, "a", 1, 50.0),
        (5, True, "Autres", 11, 15.0),
    ]
    assert sum(g[4] for g in got) == sum(r[2] for r in rows)


def test_top_and_others_with_few_members_keeps_an_empty_rest(spark):
    assert report(spark, [("a", 1, 5.0)]) == [(1, False, "a", 1, 5.0), (5, True, "Autres", 0, 0.0)]


def test_null_member_among_the_rest_is_added_up(spark):
    got = report(spark, [("a", 1, 5.0), ("b", 1, 4.0), (None, 7, 1.0)], n=2)
    assert got[-1] == (3, True, "Autres", 7, 1.0)


def test_first_per_key_with_hot_key(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, ord bigint, flow string, kind string, v double").repartition(5)
    got = {r["k"]: r["ord"] for r in rank.first_per_key(df, ["k"], ["ord"]).collect()}
    assert got == {k: min(r[1] for r in rows if r[0] == k) for k in {r[0] for r in rows}}


def test_largest_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 2.0), ("d", 1.0)], "k string, v double")
    assert [r["k"] for r in rank.largest(df, 3, "v", "k").collect()] == ["b", "c", "d"]


def test_lookup_defaults(spark):
    df = spark.createDataFrame([("10",), ("77",), (None,)], "code_in string")
    dim = dims.code_dim(spark, fixed.FLOW_TYPES)
    label = "APD (Aide Publique au Développement)"

    def got(**kw):
        return {r["code_in"]: r["out"] for r in dims.lookup(df, dim, "code_in", "out", **kw).collect()}

    assert got() == {"10": label, "77": None, None: None}
    assert got(default=F.col("code_in")) == {"10": label, "77": "77", None: None}
    assert got(default="Autre") == {"10": label, "77": "Autre", None: "Autre"}


def test_code_dim_keeps_quotes(spark):
    labels = {r["code"]: r["label"] for r in dims.code_dim(spark, fixed.SECTORS).collect()}
    assert labels["15160"] == "Droits de l'homme" and len(labels) == 86


def test_set_operators(spark):
    a = sets.identifiers(spark.createDataFrame([(" x ",), ("y",), (None,), ("y ",)], "id string"), "id")
    b = sets.identifiers(spark.createDataFrame([("y",), ("z",)], "id string"), "id")
    assert sorted(r[0] for r in a.collect()) == ["x", "y"]
    assert [r[0] for r in sets.only_in(a, b).collect()] == ["x"]
    assert [r[0] for r in sets.in_both(a, b).collect()] == ["y"]


def test_dealt_identifiers_stay_in_their_parts(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as for sets that are too large to broadcast
    try:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = [[(f"{k}",) for k in range(n, n + 50)] * 2 + [(None,)] for n in (0, 30)]
        a, b = (sets.identifiers(spark.createDataFrame(r, "id string"), "id") for r in rows)
        of_a, of_b = (sets.dealt(known, "identifier", least + 3) for known in (a, b))
        assert sets.only_in(a, b).rdd.getNumPartitions() == 1  # merged
        for made, expected in ((sets.only_in(a, of_b), range(30)), (sets.only_in(b, of_a), range(50, 80)), (sets.in_both(a, of_b), range(30, 50))):
            assert made.rdd.getNumPartitions() >= least
            assert sorted(int(r[0]) for r in made.collect()) == list(expected)
    finally:
        spark.conf.set(threshold, before)


def test_stacked_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2,)], "n int")
    assert sorted((r["n"], r["s"]) for r in sets.stacked(a, b).collect()) == [(1, "x"), (2, None)]


def test_filters(spark):
    df = spark.createDataFrame([("100",), (None,), ("0",), ("40",), ("n/a",)], "p string")
    assert [r["p"] for r in df.where(filters.full_or_missing_share(df, "p")).collect()] == ["100", None]
    assert [r["p"] for r in df.where(filters.positive_share(df, "p")).collect()] == ["100", None, "40", "n/a"]
    trades = spark.createDataFrame(
        [("FRA", 1.0), ("WLD", 1.0), ("", 1.0), (None, 1.0), ("ARE", 0.0), ("ARE", None), ("EUN", 2.0)], "p string, v double")
    assert [r["p"] for r in trades.where(filters.traded(F.col("p"), F.col("v"))).collect()] == ["FRA", "EUN"]
    assert [r["p"] for r in trades.where(filters.traded(F.col("p"), F.col("v"), ["WLD", "", "EUN"])).collect()] == ["FRA"]
    texts = spark.createDataFrame([("Comoros",), (None,), ("France",), ("COMORES",)], "t string")
    assert [r["t"] for r in texts.where(filters.text_contains(F.col("t"), "comoro")).collect()] == ["Comoros"]
    codes = spark.createDataFrame([(90500,), (901,)], "c int")
    assert [r["c"] for r in codes.where(filters.code_starts_with(F.col("c"), "905")).collect()] == [90500]


def test_joins(spark):
    base = spark.createDataFrame([("a", "en a", "d"), ("b", "en b", "e")], "k string, title string, d string")
    french = spark.createDataFrame([("a", None, "fd"), ("b", "fr b", None)], "k string, title string, d string")
    got = {r["k"]: (r["title"], r["d"]) for r in joins.translated(base, french, "k", ["title", "d"]).collect()}
    assert got == {"a": ("en a", "fd"), "b": ("fr b", "e")}
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [r["k"] for r in joins.restricted(base, keys, "k").collect()] == ["a"]
    assert [r["k"] for r in joins.excluded(base, keys, "k").collect()] == ["b"]
    null_key = spark.createDataFrame([(None,)], "k string")
    assert joins.excluded(null_key, keys, "k").count() == 1
    left = spark.createDataFrame([("2019", 1.0)], "year string, l double")
    right = spark.createDataFrame([("2020", 2.0)], "year string, r double")
    assert sorted(tuple(r) for r in joins.outer_by(left, right, "year").collect()) == [("2019", 1.0, 0.0), ("2020", 0.0, 2.0)]


def test_three_way_lookup(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    snapshot = spark.createDataFrame([("a", 2, True), ("b", None, True), ("c", 1, False)], "i string, n int, asked boolean")
    got = {r["id"]: r["registry_status"] for r in joins.looked_up(
        ids, snapshot, "id", "i", F.col("n").isNotNull(), F.col("asked")).collect()}
    assert got == {"a": "found", "b": "not_found", "c": "unanswered", "d": "unanswered"}


def test_grouping_with_and_without_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", None)], "k string, v double")
    count = F.count("v").alias("n")
    assert {r["k"]: r["n"] for r in aggregates.grouped(df, ["k"], count).collect()} == {"a": 1}
    assert {r["k"]: r["n"] for r in aggregates.grouped(df, ["k"], count, null_keys=True).collect()} == {"a": 1, None: 1}


def test_spread(spark):
    import statistics
    gaps = [1.0, 2.5, 9.0, None]
    row = aggregates.gap_spread(spark.createDataFrame([(g,) for g in gaps], "p double"), "p").first()
    assert row["n_gaps"] == 3 and row["median_gap"] == 2.5
    assert row["spread"] == pytest.approx(statistics.stdev(gaps[:3]))


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select.in_order(df, ["c", "x", "a"]).columns == ["c", "a"]
    assert select.without(df, "b", "nope").columns == ["a", "c"]
    assert select.renamed(df, {"a": "z"}).columns == ["z", "b", "c"]
    assert select.with_constants(df, k="v").first()["k"] == "v"
    many = spark.range(10)
    assert [r["id"] for r in select.page(many, [F.col("id")], 3, 1).collect()] == [3, 4, 5]


def test_a_page_reads_its_range_only(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("key")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would be one file
    try:
        pages = select.Pages(df, ["key"], 100, f"file://{tmp_path}/pages")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    page = pages.page(57)
    assert sorted((r["position"], r["key"]) for r in page.collect()) == [(5701 + i, 5700 + i) for i in range(100)]
    assert "GreaterThan(position,5700), LessThanOrEqual(position,5800)" in page._jdf.queryExecution().executedPlan().toString()
    import pyarrow.parquet as pq

    ranges = [pq.ParquetFile(p).metadata.row_group(0).column(0).statistics for p in (tmp_path / "pages").glob("*.parquet")]
    assert len(ranges) > 1 and sum(r.min <= 5800 and r.max > 5700 for r in ranges) == 1
    assert pages.firsts().count() == 200 and pages.page(200).count() == 0


def test_lists_are_collected_where_their_key_is(spark):
    rows = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 3, "a"), (None, 4, None)], "k string, ord long, c string")
    made = aggregates.ordered_lists(rows, "k", "ord", ["c"])
    lines = [line.strip(" :+-*0123456789()") for line in made._jdf.queryExecution().executedPlan().toString().splitlines()]
    below = [b for a, b in zip(lines, lines[1:]) if a.startswith("Exchange hashpartitioning(k")]
    assert len(below) == 2
    assert not any(b.startswith("ObjectHashAggregate") for b in below)  # no list moves
    assert {r["k"]: r["c"] for r in made.collect()} == {"x": ["a", "b"], "y": ["a"], None: []}
    settled = aggregates.ordered_lists(rows, "k", "ord", ["c"], in_place=True)
    assert sorted(map(str, settled.collect())) == sorted(map(str, made.collect()))
