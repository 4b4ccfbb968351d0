"""Loading each landed file once.

:func:`load_new_files` leaves the book-keeping to Structured Streaming: the file source with ``availableNow`` takes what
has arrived since the last run and stops; its checkpoint knows the files already loaded, but not what was in them.

:func:`load_landed` keeps a manifest that others can read: files are taken in numbered batches, each written to a folder of its
own beside the list of its files and their row counts, also of files without rows. The list is written last, so a batch
counts once it is whole; one that broke off is written anew under the same number.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.session import checkpoint_dir


def new_files(
    spark: SparkSession, landing: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Rows of landed CSV files, with the file they came from."""
    reader = spark.readStream.schema(schema).option("header", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing).withColumn("source_file", F.col("_metadata.file_name"))


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table_path: str,
    name: str,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Append the rows of new files to a Parquet table and return the finished query."""
    base = checkpoint or checkpoint_dir(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    query = (
        new_files(spark, landing, schema)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", f"{base}/incremental/{name}")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


# ------------------------------------------------------------------ batches with a manifest

MANIFEST = "batch long, file string, file_name string, length long, rows long"


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """``batch, file, file_name, length, rows`` of every file that is loaded."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{base}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def records(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The rows of all whole batches, with ``source_file`` and ``batch``."""
    stored = T.StructType([*schema, T.StructField("source_file", T.StringType()), T.StructField("batch", T.LongType())])
    done = manifest(spark, base).select("batch").distinct()
    return spark.read.schema(stored).parquet(f"{base}/records").join(done, "batch", "left_semi")


def load_landed(spark: SparkSession, landing: str, schema: T.StructType, base: str, most_files: int = 1000) -> int:
    """Load the files that no whole batch has yet, ``most_files`` at a time; the number of batches made."""
    batches = 0
    while True:
        known = manifest(spark, base)
        listed = spark.read.format("binaryFile").load(landing).select(F.col("_metadata.file_path").alias("file"), "length")
        waiting = listed.join(known.select("file"), "file", "left_anti").orderBy("file").limit(most_files).collect()
        if not waiting:
            return batches
        number = 1 + (known.agg(F.max("batch")).first()[0] or 0)
        _load_batch(spark, [row["file"] for row in waiting], schema, base, number)
        batches += 1


def _load_batch(spark: SparkSession, files: list[str], schema: T.StructType, base: str, number: int) -> None:
    """Write the rows of some files, then the list of the files; a second run under one number replaces both."""
    paths = [unquote(f) for f in files]  # Spark names files with escapes and takes them without
    rows = spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(paths)
    rows.withColumn("source_file", F.col("_metadata.file_path")).write.mode("overwrite").parquet(f"{base}/records/batch={number}")
    stored = T.StructType([*schema, T.StructField("source_file", T.StringType())])
    counts = spark.read.schema(stored).parquet(f"{base}/records/batch={number}").groupBy("source_file").agg(F.count("*").alias("rows"))
    sizes = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "length")
    lines = sizes.join(counts, F.col("file") == F.col("source_file"), "left").select(
        "file", F.element_at(F.split("file", "/"), -1).alias("file_name"), "length", F.coalesce("rows", F.lit(0)).alias("rows")
    )
    lines.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/batch={number}")
