"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution picks join strategies, merges small partitions and splits
# hot ones from sizes seen at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, work_folder: str | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName("anaquel")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if work_folder:
        builder = builder.config("spark.checkpoint.dir", work_folder)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables and stream state.

    It lies under ``spark.checkpoint.dir``, which names storage that all executors share. Only a session of one
    process (a local master) without that setting gets a temporary folder; elsewhere its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="anaquel-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame that several later steps read to the shared folder, and read it from there.

    This also ends its lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = work_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Bound what one Arrow batch holds by bytes too, where the session sets no bound: rows can be long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(most))


def bound_splits(spark: SparkSession, most: int = 16 << 20) -> None:
    """Bound what one task scans, where the session sets no bound.

    Rows derived from columnar files are many times as large as what is read for them: a sort in the same task would spill.
    """
    key = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(most))


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark a narrow key frame for broadcast, but only after counting that it is small.

    Beyond the limit the frame is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def unsent(df: DataFrame) -> DataFrame:
    """Let a join with this frame shuffle, never broadcast.

    For frames as large as the data: Spark sizes a frame by its files and takes an exploded one for no larger than what it
    was made of, so it may broadcast by way of the driver what is many times the limit.
    """
    return df.hint("merge")
