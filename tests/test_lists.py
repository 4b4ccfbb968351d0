"""Numbered places and cells of text made from them."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lists
from ledgerloom.operators.aggregates import joined_text, ordered_lists
from ledgerloom.plans import aid

SCHEMA = "aid string, ord long, location_name string, location_latitude string, location_longitude string"
ROWS = [
    ("A", 7, "x", "1", "2"), ("A", 3, "y", None, "2"), ("A", 9, "x", "1", "2"), ("A", 11, "x", "5", None), ("B", 1, None, None, None),
    ("B", 2, None, None, None), (None, 4, "n", "0", "0"), ("C", 8, ",", "", " "), ("C", 6, "", "1", "1"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def text_of(frame):
    return {tuple(r) for r in frame.select("aid", *aid.PLACE).collect()}


def test_places_are_numbered_by_first_appearance(spark):
    got = sorted((tuple(r) for r in aid.places(table(spark, ROWS)).collect()), key=repr)
    assert got == sorted([
        ("A", 1, "y", None, "2"), ("A", 2, "x", "1", "2"), ("A", 3, "x", "5", None), ("B", 1, None, None, None),
        (None, 1, "n", "0", "0"), ("C", 1, "", "1", "1"), ("C", 2, ",", "", " "),
    ], key=repr)


@pytest.mark.parametrize("piece", [1, 2, 1024])
def test_cells_are_those_of_one_array(spark, monkeypatch, piece):
    monkeypatch.setattr(lists, "PIECE", piece)
    rows = ROWS + [("D", 100 - i, f"p{i % 11}", str(i % 7), None) for i in range(60)]
    one = ordered_lists(table(spark, rows), "aid", "ord", aid.PLACE).withColumns({c: joined_text(c) for c in aid.PLACE})
    assert text_of(lists.cells(aid.places(table(spark, rows)), "aid", aid.PLACE)) == text_of(one)


def test_large_and_small_activities_meet(spark, monkeypatch):
    expected = text_of(aid.locations_per_activity(table(spark, ROWS)))
    monkeypatch.setattr(aid, "PIECE", 2)
    assert text_of(aid.locations_per_activity(table(spark, ROWS))) == expected


def test_an_activity_with_a_million_places(spark):
    """Arrays stay short: the longest holds a thousand values of the million."""
    rows = spark.range(1_000_000).select(
        F.when(F.col("id") % 50 == 49, F.concat(F.lit("S"), "id")).otherwise(F.lit("HOT")).alias("aid"), F.col("id").alias("ord"),
        F.concat(F.lit("p"), "id").alias("location_name"), F.lit("1").alias("location_latitude"),
        (F.col("id") % 3).cast("string").alias("location_longitude"),
    )
    cells = aid.locations_per_activity(rows)
    hot = cells.where("aid = 'HOT'").select(
        F.length("location_name").alias("n"), F.md5("location_name").alias("digest"), "location_latitude", "location_longitude"
    ).first()
    names = ", ".join(f"p{i}" for i in range(1_000_000) if i % 50 != 49)
    import hashlib

    assert (hot["n"], hot["digest"]) == (len(names), hashlib.md5(names.encode()).hexdigest())
    assert (hot["location_latitude"], hot["location_longitude"]) == ("1", "0, 1, 2")
    assert cells.count() == 20_001
