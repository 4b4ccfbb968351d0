"""Exact dedup: texts that are the same but for blanks, tabs and line ends form one group.

Rows are grouped by a 128-bit hash of the normalised text and, inside a hash, by its bytes, so a
collision never joins two texts. Grouping keeps one row for each text and map task, so a text that
a third of all rows have is no hot key. Built-in functions only.

Defined results: null text counts as empty; empty texts are copies of each other; of a group the row with
the most code points stays, then the smallest id, null ids last. Rows that repeat id, text and
length are told apart nowhere: the report marks each of them, :func:`without_copies` keeps one.
Other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty, without_spaces


def _hash(normal: Column) -> Column:
    return F.unhex(F.md5(normal.cast("binary")))


def _groups(docs: DataFrame) -> DataFrame:
    """One row for each distinct normalised text: hashes, size, the row that stays."""
    normal = without_spaces(text_or_empty())
    rows = docs.select("doc_id", normal.alias("normal"), F.char_length(text_or_empty()).cast("long").alias("chars"))
    best = F.struct((-F.col("chars")).alias("fewer"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    return (
        rows.groupBy(_hash(F.col("normal")).alias("hash"), "normal")
        .agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
        .select(
            "hash", F.unhex(F.sha2(F.col("normal").cast("binary"), 256)).alias("sha"), "group_size",
            F.col("best.doc_id").alias("keep_id"), (-F.col("best.fewer")).alias("keep_chars"),
        )
    )


def _keys(docs: DataFrame) -> list[Column]:
    normal = without_spaces(text_or_empty())
    return [
        _hash(normal).alias("row_hash"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("row_sha"),
        F.char_length(text_or_empty()).cast("long").alias("chars"),
    ]


SAME_TEXT = "row_hash = hash AND row_sha = sha"
STAYS = "row_id <=> keep_id AND chars = keep_chars"


def copy_report(docs: DataFrame) -> DataFrame:
    """Every row: doc_id, keep_id (the row that stays), group_size, kept, text_sha256."""
    rows = docs.select(F.col("doc_id").alias("row_id"), *_keys(docs))
    return rows.join(_groups(docs), F.expr(SAME_TEXT)).select(
        F.col("row_id").alias("doc_id"), "keep_id", "group_size", F.expr(STAYS).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their columns as they were.

    The id is part of the join key, so the many rows of a large group are spread over all tasks.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("row_id"), *_keys(docs))
    stay = rows.join(_groups(docs), F.expr(f"{SAME_TEXT} AND {STAYS}"), "left_semi")
    return stay.dropDuplicates(["row_hash", "row_sha", "row_id", "chars"]).select("row.*")
