"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import json
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anaquel.session import bound_batches, materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, in any case of letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def ranged(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``df`` sorted over ranges and written, with ``_part``, a row's range, and ``_at``, its place in the order."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    return rows.withColumn("_part", F.shiftright("_at", 33))


def running(rows: DataFrame, group: str | None, sums: dict[str, Column]) -> DataFrame:
    """A table of ``ranged`` (by ``group`` first) plus, for each of ``sums``, the sum over all rows of its group up to the
    row itself; over all rows without a group.

    Windows run within a group's rows of one range. Groups that span ranges get what their earlier ranges sum to: at
    most two rows per range, so this side of the join is small by construction. Groups must not be null.
    """
    keys = ["_part"] if group is None else [group, "_part"]
    held = rows
    if group is not None:
        # Only the first and the last group of a range can go on in another.
        spans = rows.groupBy("_part").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
        edges = spans.select("_part", F.explode(F.array_distinct(F.array("_low", "_high"))).alias(group))
        held = rows.join(F.broadcast(edges), keys)
    held = held.groupBy(*keys).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys[:-1]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(*keys, *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    within = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = [(F.coalesce(F.col(f"_{n}"), F.lit(0)) + F.sum(c).over(within)).alias(n) for n, c in sums.items()]
    return rows.join(F.broadcast(offsets), keys, "left").select(*rows.columns, *summed)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of a session, once: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="anaquel-")) / "anaquel_package.zip"
        with zipfile.ZipFile(archive, "w") as package:
            for source in sorted(root.rglob("*.py")):
                package.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def lean(run: Callable) -> Callable:
    """A task's function that gives memory back at its end: a worker that waits for its next task holds little."""
    ship(SparkSession.active())
    bound_batches(SparkSession.active())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task


def with_arrow_column(
    df: DataFrame, inputs: list[str], out: str, kind: str, make: Callable[..., Iterable], arrow: pa.DataType
) -> DataFrame:
    """``df`` plus the column ``out`` (one that is there is replaced), made batch by batch.

    ``make`` gets one Arrow array per name in ``inputs`` and returns an Arrow array of the same length.
    """
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in kept]).add(out, T._parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(*[batch.column(batch.schema.names.index(c)) for c in inputs])
            columns = [batch.column(batch.schema.names.index(c)) for c in kept] + [made]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, out])

    return df.mapInArrow(lean(run), schema)


class Memo(dict):
    """Answers of a pure function; emptied when full, so that memory stays bounded and results are the same."""

    def __init__(self, function: Callable, most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def last_at_most(bounds: list[int], value: Column) -> Column:
    """Index of the last of the sorted ``bounds`` that is not above ``value``; -1 if all are.

    A binary search over a literal array, so its cost per row is the logarithm of the bounds.
    """
    if not bounds:
        return F.lit(-1)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    listed = F.from_json(F.lit(json.dumps([int(b) for b in bounds])), "array<bigint>")  # folded to a constant
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(listed, at + step - 1) <= value), at + step
        ).otherwise(at),
    )
    return found - 1
