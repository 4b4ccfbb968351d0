"""Products in versions: a reader meets a whole product or the one before, never half of one.

The datasets of a product are written to a folder of the version's own. Last of all one small file is added to
``<base>/pointers``: it names the datasets of the version with their folders, formats, schemas and orders. A job that
fails before that leaves a folder that nothing points to, and readers go on with the version before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ledgerloom.sources.audit import counted, require_rows, seen_rows

POINTER = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("name", T.StringType()), T.StructField("folder", T.StringType()),
    T.StructField("format", T.StringType()), T.StructField("schema", T.StringType()),
    T.StructField("sorted_by", T.ArrayType(T.StringType())), T.StructField("rows", T.LongType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
])


class NoVersion(LookupError):
    """The product has no version, or the version no such dataset."""


def newest(spark: SparkSession, base: str) -> dict[str, Row]:
    """The pointer rows of the newest version by dataset; nothing before the first one."""
    try:
        pointers = spark.read.schema(POINTER).parquet(f"{base}/pointers")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    last = pointers.agg(F.max("version")).first()[0]
    return {row["name"]: row for row in pointers.where(F.col("version") == last).collect()}  # one for each dataset


def read_at(spark: SparkSession, entry: Row) -> DataFrame:
    """A dataset as published: its types and the order of its columns, wherever partition columns are stored."""
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    reader = spark.read.schema(schema).format(entry["format"])
    if entry["format"] == "csv":
        reader = reader.option("header", "true")
    return reader.load(entry["folder"]).select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema])


def read_version(spark: SparkSession, base: str, name: str, ordered: bool = False) -> DataFrame:
    """A dataset of the newest version; ``ordered``: sorted as published."""
    entries = newest(spark, base)
    if name not in entries:
        raise NoVersion(f"{base}: {name}")
    df = read_at(spark, entries[name])
    by = entries[name]["sorted_by"]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in by]) if ordered and by else df


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a dataset.

    Before a partitioned write the rows are rebalanced by the partition columns: AQE puts
    small folders together in one task and splits a large one over several, so there are
    neither many small files nor one task with a third of the rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


class Version:
    """A version in the making: datasets are added and can be read at once, :meth:`commit` shows them to readers."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        before = newest(spark, base)
        self.spark, self.base = spark, base
        self.number = 1 + max((row["version"] for row in before.values()), default=0)
        self.folder = f"{base}/versions/{self.number:06d}-{uuid.uuid4().hex}"
        self.entries: dict[str, Row] = {}

    def add(
        self, name: str, df: DataFrame, fmt: str = "parquet", partition_by: list[str] | None = None,
        sorted_by: list[str] | None = None, writer=None, details: dict[str, str] | None = None,
    ) -> DataFrame:
        """Write a dataset, its rows counted on the way, and return what was written."""
        observed, seen = counted(df, f"{name}-{uuid.uuid4().hex}")
        folder = f"{self.folder}/{name}"
        if writer:
            writer(observed, folder)
        else:
            write(observed, folder, fmt, partition_by)
        values = (self.number, name, folder, fmt, df.schema.json(), sorted_by or [], None, details or {})
        entry = Row(**dict(zip(POINTER.names, values)))
        rows = seen_rows(seen, lambda: read_at(self.spark, entry).count())
        self.entries[name] = Row(**(entry.asDict() | {"rows": rows}))
        return read_at(self.spark, entry)

    def commit(self, inputs: dict[str, int] | None = None, required: list[str] | None = None) -> None:
        """Point readers to this version.

        ``inputs`` are the rows of each input, which go with the rows of each dataset to ``run``; where one of
        the ``required`` ones has none the job stops and the pointer stays.
        """
        inputs = inputs or {}
        for name in required or []:
            require_rows(inputs[name], name)
        lines = [("input", n, r) for n, r in inputs.items()] + [("dataset", n, e["rows"]) for n, e in self.entries.items()]
        self.add("run", self.spark.createDataFrame(lines, "kind string, name string, rows long").coalesce(1))
        pointer = self.spark.createDataFrame(list(self.entries.values()), POINTER).coalesce(1)
        pointer.write.mode("append").parquet(f"{self.base}/pointers")  # one file, moved into place as a whole
