"""Releases, bulk files, filtered reads and code lists of the trade source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom import schemas


def listed(field: str, schema: T.StructType) -> T.StructType:
    """The schema of answers that hold their rows as a list in one field."""
    return T.StructType([T.StructField(field, T.ArrayType(schema))])


RELEASE_LIST = listed("data", schemas.RELEASES)
AVAILABILITY_LIST = listed("data", schemas.AVAILABILITY)
CODE_LIST = listed("results", schemas.CODE_LIST)


def listed_rows(answers: DataFrame, field: str, doc: str | None = None) -> DataFrame:
    """Rows of answers with a list in ``field``; ``doc`` names the struct column that holds the answer."""
    return answers.select(F.inline(f"{doc}.{field}" if doc else field))


def read_releases(spark: SparkSession, path: str) -> DataFrame:
    """The release list: ``{"data": [{...}]}``."""
    return listed_rows(spark.read.schema(RELEASE_LIST).json(path, multiLine=True, mode="FAILFAST"), "data")


def read_bulk(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Bulk CSV files with a header, plain or gzip; text columns unless a schema is given."""
    reader = spark.read.option("header", "true")
    return (reader.schema(schema) if schema else reader).csv(path)


def select_records(
    records: DataFrame,
    period: list[str] | None = None,
    reporter: list[str] | None = None,
    commodity: list[str] | None = None,
    flow: list[str] | None = None,
    max_records: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Records by period, reporter, commodity and flow.

    On files partitioned by period and flow the first and last filter prune folders.
    ``max_records`` is the row limit that the caller asks for, none by default; it needs an ``order``.
    """
    wanted = {"period": period, "reporterCode": reporter, "cmdCode": commodity, "flowCode": flow}
    for column, values in wanted.items():
        if values is not None:
            records = records.where(F.col(column).cast("string").isin([str(v) for v in values]))
    if max_records is None:
        return records
    if not order:
        raise ValueError("a limit needs an order")
    return records.orderBy(*order).limit(max_records)


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """``id, text`` of a reference list, from ``{"results": [...]}`` or CSV files."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return read_bulk(spark, path, schemas.CODE_LIST)
    return listed_rows(spark.read.schema(CODE_LIST).json(path, multiLine=True, mode="FAILFAST"), "results")


def read_availability(spark: SparkSession, path: str) -> DataFrame:
    return listed_rows(spark.read.schema(AVAILABILITY_LIST).json(path, multiLine=True, mode="FAILFAST"), "data")
