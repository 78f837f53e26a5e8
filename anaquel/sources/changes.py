"""Changes per key from a stream, kept in folders that merge by levels.

Each micro-batch is written to a folder of its own. When ``FANOUT`` to the power of k batches are complete, the folders
of that stretch are merged into one, which holds the newest row per key. So after n batches there are at most
``FANOUT - 1`` folders per level, a number that grows with the logarithm of n, and each row is rewritten once per level.

A folder is named by its first and last batch and counts once Spark has marked it as written. Readers take the widest
complete folders; a merge that dies leaves the narrower ones in use. Folders that a wider one covers go when the next
batch arrives, so a reader that has just listed them can finish. The path belongs to one stream checkpoint, because the
numbers of batches are its.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators.dedup import keep_last
from anaquel.sources.folders import children, file_system, remove

FANOUT = 4
#: The column that says which batch brought a row.
BATCH = "batch"

Stretch = tuple[int, int]


def _folder(path: str, stretch: Stretch) -> str:
    return f"{path}/{stretch[0]}-{stretch[1]}"


def _complete(spark: SparkSession, path: str) -> list[Stretch]:
    """Stretches of batches with a complete folder; of those that start together, the widest is first."""
    found = []
    for name in children(spark, path):
        first, dash, last = name.partition("-")
        if dash and first.isdigit() and last.isdigit():
            files, mark = file_system(spark, f"{path}/{name}/_SUCCESS")
            if files.exists(mark):
                found.append((int(first), int(last)))
    return sorted(found, key=lambda s: (s[0], -s[1]))


def stretches(spark: SparkSession, path: str) -> list[Stretch]:
    """The widest complete stretches, oldest first; they do not overlap."""
    widest: list[Stretch] = []
    for stretch in _complete(spark, path):
        if not widest or stretch[0] > widest[-1][1]:
            widest.append(stretch)
    return widest


def _read(spark: SparkSession, path: str, wanted: list[Stretch]) -> DataFrame:
    return spark.read.parquet(*[_folder(path, s) for s in wanted])


def add_changes(batch: DataFrame, path: str, number: int, keys: list[str]) -> None:
    """Write a micro-batch, then merge what it completes. A repeated batch ends with the same table."""
    spark = batch.sparkSession
    current = stretches(spark, path)
    for stretch in set(_complete(spark, path)) - set(current):
        remove(spark, _folder(path, stretch))
    if not any(first <= number <= last and first < last for first, last in current):
        rows = batch.withColumn(BATCH, F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(_folder(path, (number, number)))
    width = FANOUT
    while (number + 1) % width == 0:
        merged = (number + 1 - width, number)
        parts = [s for s in stretches(spark, path) if merged[0] <= s[0] and s[1] <= merged[1]]
        if len(parts) > 1:
            newest = keep_last(_read(spark, path, parts), keys, [BATCH])
            newest.write.mode("overwrite").parquet(_folder(path, merged))
        width *= FANOUT


def scan_changes(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key."""
    return keep_last(_read(spark, path, stretches(spark, path)), keys, [BATCH]).drop(BATCH)
