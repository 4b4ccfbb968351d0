"""Session settings.

On a cluster everything that depends on the hardware (master, memory, executors) comes
from ``spark-submit``; only settings that belong to the engine are made here. The number
of shuffle partitions follows the input: see :func:`shuffle_partitions_for`.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Partitions of about 128 MB each, never fewer than the cores.

    AQE merges small ones at run time, so the count only has to be large enough that no
    partition outgrows an executor's memory.
    """
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def build_session(
    app: str = "ledgerloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false"
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if there is one."""
    return spark.conf.get("spark.checkpoint.dir", None) or None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster or set before; one of our own only where none is, on a local master."""
    folder = checkpoint_dir(spark) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return "file://" + tempfile.mkdtemp(prefix="run-")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table below the shared folder, read back: its size is known to the optimizer."""
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder; later steps read them from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
