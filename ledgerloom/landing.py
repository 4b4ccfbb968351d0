"""Raw files parsed once, into typed tables that all jobs read.

Each raw table becomes a Parquet table in buckets of its key, sorted by key and arrival inside them, with Bloom filters on
the key: groupings and joins by the key need no exchange, and small sets of keys skip row groups. Amounts are numbers,
all else is the text of the source. What a table was made from (names, lengths and times of its raw files) is kept with
it; while that stays the same nothing is parsed again, by whatever job.

A table whose largest bucket holds far more than the others is opened without its buckets, so that a key with a third
of all rows is no single task; it is then shuffled like any other table, after partial aggregation.

Trade series land by flow and section: a section that lands again replaces itself and nothing else, and what cannot be
read in it is kept whole, with its file, in a table of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom import schemas
from ledgerloom.functions import clean
from ledgerloom.plans.aid import AidTables
from ledgerloom.plans.second_source import SecondTables
from ledgerloom.session import shuffle_partitions_for, written
from ledgerloom.sinks.versions import Version, newest, read_at
from ledgerloom.sources import envelopes, sdmx

#: A bucket with so many times the mean makes a table uneven, once it has rows enough to matter.
UNEVEN, SMALL_BUCKET = 4, 1_000_000
#: Bytes of raw Parquet files for one bucket: a task that groups and joins a bucket of every table holds their rows unpacked.
BUCKET_BYTES = 16 << 20


# ------------------------------------------------------------------ what has landed

def listing(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, modified`` of raw files, and the partition columns of their folders; no file is opened."""
    files = spark.read.format("binaryFile").load(path)
    folders = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"), *folders)


def _state() -> list[Column]:
    """Number, bytes and a digest of files, whatever their order."""
    one = F.xxhash64("file", "length", "modified").cast("decimal(38,0)")
    return [F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.sum(one).cast("string").alias("digest")]


# ------------------------------------------------------------------ tables in buckets

def write_in_buckets(df: DataFrame, path: str, key: str, order: list[str], buckets: int) -> None:
    """A Parquet table in buckets. Rows are dealt out as the buckets are; AQE splits what is too large for one task."""
    name = _catalog_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.hint("rebalance", buckets, key).write.format("parquet").mode("overwrite")
        .option("path", path).option(f"parquet.bloom.filter.enabled#{key}", "true")
        .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name)
    )


def buckets_for_files(spark: SparkSession, paths: list[str], least: int) -> int:
    """One number of buckets for all tables made from these files; it grows with them, so that a bucket does not."""
    sizes = [listing(spark, path).agg(F.sum("length")).first()[0] or 0 for path in paths]
    return max(least, -(-sum(sizes) // BUCKET_BYTES))


def open_in_buckets(spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[str], buckets: int) -> DataFrame:
    """The table of :func:`write_in_buckets`, also in a session that has not seen it."""
    name = _catalog_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet CLUSTERED BY (`{key}`)"
        f" SORTED BY ({', '.join(f'`{c}`' for c in [key, *order])}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _catalog_name(path: str) -> str:
    return f"landed_{hashlib.md5(path.encode()).hexdigest()}"  # paths are new for each version


def _bucket_sizes(df: DataFrame, key: str, buckets: int) -> tuple[int, int]:
    """Rows in all, and in the largest bucket."""
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))
    row = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    return row["rows"] or 0, row["largest"] or 0


@dataclass(frozen=True)
class Landed:
    """A landed table and how many rows it has."""

    table: DataFrame
    rows: int


def land_table(
    spark: SparkSession, raw: str, base: str, parse: Callable[[], DataFrame], key: str, numbers: tuple[str, ...] = (),
    buckets: int | None = None,
) -> Landed:
    """The typed table below ``base`` of the raw files at ``raw``; parsed only where those are not what it was made from."""
    state = listing(spark, raw).agg(*_state()).first()
    entry = newest(spark, base).get("rows")
    if entry is None or entry["details"]["digest"] != state["digest"]:
        count = buckets or shuffle_partitions_for(state["bytes"] or 0, spark.sparkContext.defaultParallelism)
        parsed = parse()
        parsed = parsed.withColumns({n: clean.number_of(parsed, n) for n in numbers})
        order = [c for c in ("ord",) if c in parsed.columns]
        version = Version(spark, base)
        stored = version.add(
            "rows", parsed, writer=lambda df, folder: write_in_buckets(df, folder, key, order, count),
            details={"digest": state["digest"], "n_files": str(state["n_files"]), "key": key, "order": ",".join(order), "buckets": str(count)},
        )
        rows, largest = _bucket_sizes(stored, key, count)
        even = largest <= max(UNEVEN * rows / count, SMALL_BUCKET)
        version.entries["rows"]["details"]["even"] = str(even)
        version.commit()
        entry = newest(spark, base)["rows"]
    return Landed(_opened(spark, entry), entry["rows"])


def _opened(spark: SparkSession, entry) -> DataFrame:
    details = entry["details"]
    if details["even"] != "True":
        return read_at(spark, entry)
    schema = read_at(spark, entry).schema
    order = [c for c in details["order"].split(",") if c]
    return open_in_buckets(spark, entry["folder"], schema, details["key"], order, int(details["buckets"]))


# ------------------------------------------------------------------ the two sources

#: Table: schema, columns that are numbers.
FIRST = {
    "act": (schemas.ACT, ()),
    "country": (schemas.COUNTRY, ()),
    "sector": (schemas.SECTOR, ()),
    "budget": (schemas.BUDGET, ("budget_value", "budget_usd", "budget_eur")),
    "trans": (schemas.TRANS, ("trans_usd", "trans_eur", "trans_value")),
    "location": (schemas.LOCATION, ()),
}
#: Table: schema, key, columns that are numbers.
SECOND = {
    "activity": (schemas.T_ACTIVITY, "_link", ()),
    "recipientcountry": (schemas.T_RECIPIENT, "_link_activity", ()),
    "transaction_breakdown": (schemas.T_BREAKDOWN, "_link_activity", ("value_usd",)),
    "budget": (schemas.T_BUDGET, "_link_activity", ("value",)),
}


def _buckets_for(spark: SparkSession, folder: str, tables: list[str]) -> int:
    """One number of buckets for all tables of a source, so that they meet bucket by bucket."""
    sizes = [listing(spark, f"{folder}/{t}").agg(F.sum("length")).first()[0] or 0 for t in tables]
    return shuffle_partitions_for(max(sizes), spark.sparkContext.defaultParallelism)


def first_source(spark: SparkSession, landed: str, out: str) -> tuple[AidTables, dict[str, int]]:
    """The tables of the first source, and the rows of each."""
    raw, base = f"{landed}/first", f"{out}/landed/first"
    buckets = _buckets_for(spark, raw, list(FIRST))
    found = {
        name: land_table(
            spark, f"{raw}/{name}", f"{base}/{name}",
            lambda name=name, schema=schema: envelopes.read_object_table(spark, f"{raw}/{name}", schema), "aid", numbers, buckets,
        )
        for name, (schema, numbers) in FIRST.items()
    }
    found["translation"] = land_table(
        spark, f"{raw}/act_translated/lang=fr", f"{base}/translation",
        lambda: envelopes.read_translated_table(spark, f"{raw}/act_translated", schemas.ACT_TRANSLATION, "fr"), "aid", (), buckets,
    )
    return AidTables(**{n: f.table for n, f in found.items()}, in_place=True), {n: f.rows for n, f in found.items()}


def second_source(spark: SparkSession, landed: str, out: str) -> tuple[SecondTables, dict[str, int]]:
    """The tables of the second source, and the rows of each."""
    raw, base = f"{landed}/second", f"{out}/landed/second"
    buckets = _buckets_for(spark, raw, list(SECOND))
    found = {
        name: land_table(
            spark, f"{raw}/{name}", f"{base}/{name}",
            lambda name=name, schema=schema: envelopes.read_array_table(spark, f"{raw}/{name}", schema), key, numbers, buckets,
        )
        for name, (schema, key, numbers) in SECOND.items()
    }
    tables = SecondTables(
        activity=found["activity"].table, recipient=found["recipientcountry"].table,
        breakdown=found["transaction_breakdown"].table, budget=found["budget"].table,
    )
    return tables, {n: f.rows for n, f in found.items()}


def with_keys(tables: AidTables | SecondTables, keys: DataFrame) -> AidTables | SecondTables:
    """The tables with their key set, computed and written once; plans take it from there."""
    return replace(tables, keys=keys)


# ------------------------------------------------------------------ trade series, by section

SECTION = ["flux", "section_code"]


@dataclass(frozen=True)
class Series:
    """Observations of all sections, what could not be read, and a line for each section."""

    observations: DataFrame
    unreadable: DataFrame
    sections: DataFrame


def _replace(df: DataFrame, path: str) -> None:
    """Replace the sections in the rows, and no other; rows are rebalanced by section first."""
    df.hint("rebalance", *SECTION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SECTION).parquet(path)


SECTIONS = "landing string, digest string, n_series long, n_obs long, n_unreadable long, flux string, section_code string"


def _sections(spark: SparkSession, base: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(SECTIONS).parquet(f"{base}/sections")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SECTIONS)
        raise


def land_series(spark: SparkSession, raw: str, base: str) -> Series:
    """Land the sections whose files are new or not what they were, and open all that have landed.

    Rows carry the digest of the files they came from. The line of a section, written last, says which is the one to
    read, so a landing that breaks off in the middle shows nothing of itself.
    """
    files = listing(spark, raw).withColumns({c: F.col(c).cast("string") for c in SECTION})
    state = files.groupBy(*SECTION).agg(*_state())
    known = _sections(spark, base).select(*SECTION, F.col("digest").alias("known"))
    changed = written(
        state.join(known, SECTION, "left").where("NOT digest <=> known").select(*SECTION, "digest"), "changed-sections"
    )
    folders = [f"{raw}/flux={r['flux']}/section_code={r['section_code']}" for r in changed.collect()]  # a line a section
    if folders:
        parsed = sdmx.read_series(spark, folders, audit=True, root=raw).withColumn("file", F.col("_metadata.file_path"))
        series = written(parsed.join(changed, SECTION).withColumnRenamed("digest", "landing"), "series")
        readable = series.where("_corrupt_record IS NULL")
        _replace(sdmx.flatten_series(readable, keep=["landing", *SECTION]), f"{base}/observations")
        silent = files.join(changed, SECTION).join(series.select("file").distinct(), "file", "left_anti")
        broken = series.where("_corrupt_record IS NOT NULL").select(
            "landing", "file", F.col("_corrupt_record").alias("record"), *SECTION
        ).unionByName(_whole(spark, raw, silent.select(F.col("digest").alias("landing"), "file", *SECTION)))
        broken = written(broken, "unreadable")
        _replace(broken, f"{base}/unreadable")
        lines = changed.withColumnRenamed("digest", "landing").join(sdmx.section_audit(series, SECTION).drop("n_unreadable"), SECTION, "left")
        lost = broken.groupBy(*SECTION).agg(F.count("*").alias("n_unreadable"))
        lines = lines.join(lost, SECTION, "left").withColumn("digest", F.col("landing"))
        _replace(lines.fillna(0).select("landing", "digest", "n_series", "n_obs", "n_unreadable", *SECTION), f"{base}/sections")
    sections = _sections(spark, base)
    current = sections.select(*SECTION, F.col("landing").alias("_landing"))
    attributes = [*sdmx.SERIES_ATTRIBUTES, *sdmx.OBS_ATTRIBUTES]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["landing", *attributes, *SECTION]])
    side = T.StructType([T.StructField(c, T.StringType()) for c in ["landing", "file", "record", *SECTION]])

    def opened(name: str, of: T.StructType) -> DataFrame:
        rows = spark.read.schema(of).parquet(f"{base}/{name}")
        return rows.join(current, [*SECTION], "inner").where("landing = _landing").drop("landing", "_landing")

    return Series(opened("observations", schema), opened("unreadable", side), sections.drop("landing", "digest"))


def _whole(spark: SparkSession, raw: str, files: DataFrame) -> DataFrame:
    """``landing, file, record, flux, section_code``: files without any record, as they are.

    Folders are read by name, so the text of good ones is not read; only broken files have a row here.
    """
    folders = [f"{raw}/flux={r['flux']}/section_code={r['section_code']}" for r in files.select(*SECTION).distinct().collect()]
    if not folders:
        return spark.createDataFrame([], "landing string, file string, record string, flux string, section_code string")
    texts = spark.read.text(folders, wholetext=True).select(F.col("_metadata.file_path").alias("_path"), F.col("value").alias("record"))
    return files.join(texts, F.col("file") == F.col("_path")).select("landing", "file", "record", *SECTION)
