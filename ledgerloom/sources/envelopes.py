"""The two JSON envelopes in which the aid sources answer.

Each answer is one document; a table lands as a folder of answers, one file per page, so
reading scales with the number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators.rank import positioned
from ledgerloom.session import written


class EnvelopeError(RuntimeError):
    """An answer reports an error instead of rows."""


# ------------------------------------------------------------- rows as objects

def object_envelope(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("rows", T.ArrayType(schema)),
        T.StructField("error", T.StringType()),
    ])


def object_rows(envelopes: DataFrame, doc: str | None = None, on_error: str = "fail") -> DataFrame:
    """Rows of envelopes ``{"rows": [{...}]}``.

    ``doc`` names a struct column that holds the envelope; by default the columns are at
    the top. An answer with ``error`` stops the job; with ``on_error="skip"`` it gives no
    rows, and :func:`error_pages` says how many there were.
    """
    rows, error = (F.col(f"{doc}.rows"), F.col(f"{doc}.error")) if doc else (F.col("rows"), F.col("error"))
    if on_error == "fail":
        message = F.concat(F.lit("source error: "), error)
        rows = F.when(error.isNull(), rows).otherwise(F.raise_error(message).cast(_type_of(envelopes, doc, "rows")))
    else:
        rows = F.when(error.isNull(), rows)
    return envelopes.select(F.inline(rows))


def _type_of(df: DataFrame, doc: str | None, field: str) -> T.DataType:
    return df.select(f"{doc}.{field}" if doc else field).schema[0].dataType


def read_object_table(
    spark: SparkSession, path: str, schema: T.StructType, on_error: str = "fail"
) -> DataFrame:
    """A landed table of the first source. A malformed file stops the job."""
    envelopes = spark.read.schema(object_envelope(_without_order(schema))).json(
        path, multiLine=True, mode="FAILFAST"
    )
    return with_arrival_order(envelopes, lambda e: object_rows(e, on_error=on_error), schema, path)


def error_pages(spark: SparkSession, path: str) -> DataFrame:
    """How many answers of a landed table there are, and how many hold an error instead of rows."""
    schema = T.StructType([T.StructField("error", T.StringType())])
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("error").alias("n_errors")
    )


def read_translated_table(spark: SparkSession, path: str, schema: T.StructType, language: str) -> DataFrame:
    """The copy of a table in one language, landed under ``lang=<language>``."""
    return read_object_table(spark, f"{path.rstrip('/')}/lang={language}", schema)


# ------------------------------------------------------------- rows as arrays

ARRAY_ENVELOPE = T.StructType([
    T.StructField("ok", T.BooleanType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("error", T.StringType()),
])


def array_rows(
    envelopes: DataFrame, schema: T.StructType, doc: str | None = None, on_error: str = "fail"
) -> DataFrame:
    """Rows of envelopes ``{"ok": true, "columns": [...], "rows": [[...]]}``.

    Values are found by the position of their name in ``columns``, so answers may order
    their columns differently; a column that an answer lacks is null.
    """
    def part(name: str) -> Column:
        return F.col(f"{doc}.{name}") if doc else F.col(name)

    rows = part("rows")
    good = F.coalesce(part("ok"), F.lit(False))
    if on_error == "fail":
        message = F.concat(F.lit("source error: "), F.coalesce(part("error"), F.lit("not ok")))
        rows = F.when(good, rows).otherwise(
            F.raise_error(message).cast("array<array<string>>")
        )
    else:
        rows = F.when(good, rows)
    places = {f.name: F.array_position(part("columns"), F.lit(f.name)) for f in schema}
    exploded = envelopes.select(
        F.struct(*[p.cast("int").alias(n) for n, p in places.items()]).alias("_at"),
        F.explode(rows).alias("_row"),
    )

    def value(name: str) -> Column:
        at = F.col(f"_at.{name}")
        return F.when(at > 0, F.try_element_at("_row", F.when(at > 0, at).otherwise(1)))

    return exploded.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_array_table(
    spark: SparkSession, path: str, schema: T.StructType, on_error: str = "fail"
) -> DataFrame:
    """A landed table of the second source."""
    envelopes = spark.read.schema(ARRAY_ENVELOPE).json(path, multiLine=True, mode="FAILFAST")
    return array_rows(envelopes, schema, on_error=on_error)


# ------------------------------------------------------------- arrival order

def _without_order(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != "ord"])


def files_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``file, place``: the files of a table in order of their whole path, runs of digits compared as numbers.

    The binary reader gives one row per file and opens none. Paths are sorted where they are, by range, and
    numbered by the counts of the ranges: no list of files is made on the driver.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    pieces = F.regexp_extract_all("file", F.lit("[0-9]+|[^0-9]+"), F.lit(0))

    def comparable(piece: Column) -> Column:
        digits = F.ltrim(piece, F.lit("0"))
        number = piece.rlike("^[0-9]")
        return F.struct(
            (~number).alias("text"), F.when(number, F.length(digits)).otherwise(0).alias("length"),
            F.when(number, digits).otherwise(piece).alias("value"), piece.alias("piece"),
        )

    return positioned(files, [F.transform(pieces, comparable), "file"], "place")


def with_arrival_order(envelopes: DataFrame, rows_of, schema: T.StructType, path: str) -> DataFrame:
    """Rows with ``ord``: place of the file among all files of the table, then position in the file.

    No two files share a place, whatever their names; the order stays the same whatever splits or executors read them.
    """
    if "ord" not in schema.names:
        return rows_of(envelopes)
    # a written table, so the optimizer knows how large the order is when it picks the join
    places = written(files_in_order(envelopes.sparkSession, path), "file-order")
    numbered = F.transform(
        F.col("rows"),
        lambda row, i: F.struct(
            (F.shiftleft(F.col("place"), 32) + i).alias("ord"),
            *[row.getField(f.name).alias(f.name) for f in schema if f.name != "ord"],
        ),
    )
    paged = envelopes.withColumn("_path", F.col("_metadata.file_path")).join(places, F.col("_path") == F.col("file"), "left")
    unknown = F.raise_error(F.concat(F.lit("file without a place: "), F.col("_path"))).cast("bigint")
    return rows_of(paged.withColumn("place", F.coalesce("place", unknown)).withColumn("rows", numbered))
