"""Which SKUs a slice of the consolidated table has shown before, by Bloom filters stored beside the table.

A bucket's filter is a list of blocks of 4,096 bits, as many as its keys ask for. A key sets all of its bits in one block, so
looking it up is one equi-join on bucket and block, and neither side is expanded. Filters belong to versions of the table,
whose files never change: a refresh makes those of new versions only, and a commit does not wait for it.

A key that its filter lacks is new, without a look at the table. The others, and those of buckets without a filter, are
compared with the rows of the buckets they fall into, so the answer is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators.slices import known_sku_filter
from anaquel.schema import SLICE, TRACKED
from anaquel.session import broadcast_if_small, materialise
from anaquel.sources.consolidated import LAYOUT, STORED, Bucket, _bucketed, _read, current
from anaquel.sources.folders import children, remove

KEY = [*SLICE, "sku"]
BLOCK_BITS = 4096
#: Ten bits a key and five set for each: about one in a hundred unknown keys is looked up in vain.
BITS_PER_KEY = 10
BITS_SET = 5
#: Blocks that are broadcast to look a batch up, about 1 kB each; beyond that the batch is shuffled by block.
MOST_BLOCKS = 30_000


def _block(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*KEY), n_blocks)


def _bits() -> Column:
    """Places of a key's bits in its block, 12 bits of a second hash for each."""
    second = F.xxhash64(F.lit("bits"), *KEY)
    return F.array(*[F.shiftrightunsigned(second, 12 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for k in range(BITS_SET)])


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit % 64)


def key_blocks(rows: DataFrame) -> DataFrame:
    """Filter blocks of stored rows: bucket, number of its blocks, block, and the bits of its words by word number.

    Bits are united before and after the shuffle, so a key that is there very often weighs no more than another.
    """
    sizes = rows.groupBy(*LAYOUT).agg(F.approx_count_distinct(F.xxhash64(*KEY)).alias("_keys"))
    sizes = sizes.select(*[F.col(c).alias(f"_{c}") for c in LAYOUT], F.ceil((F.col("_keys") + 1) * BITS_PER_KEY / BLOCK_BITS).alias("n_blocks"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LAYOUT]
    placed = rows.join(broadcast_if_small(sizes), reduce(lambda a, b: a & b, same))
    set_bits = placed.select(*LAYOUT, "n_blocks", _block(F.col("n_blocks")).alias("block"), F.explode(_bits()).alias("_bit"))
    words = set_bits.groupBy(*LAYOUT, "n_blocks", "block", F.shiftright("_bit", 6).alias("_word")).agg(
        F.bit_or(_mask(F.col("_bit"))).alias("_bits")
    )
    held = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))
    return words.groupBy(*LAYOUT, "n_blocks", "block").agg(held.alias("words"))


def _has_filter(spark: SparkSession, path: str, version: str) -> bool:
    return "_SUCCESS" in children(spark, f"{path}/keys/version={version}")


def refresh_known_keys(spark: SparkSession, path: str) -> None:
    """Make the filters of versions that have none, and drop those of versions that no manifest's folders need."""
    versions = {b.version for b in current(spark, path)[1]}
    for version in sorted(versions):
        if not _has_filter(spark, path, version):
            rows = spark.read.schema(STORED).parquet(f"{path}/data/version={version}")
            key_blocks(rows).write.mode("overwrite").parquet(f"{path}/keys/version={version}")
    stored = set(children(spark, f"{path}/data"))
    for folder in set(children(spark, f"{path}/keys")) - stored:
        remove(spark, f"{path}/keys/{folder}")


def _marked(spark: SparkSession, path: str, batch: DataFrame, buckets: list[Bucket]) -> DataFrame:
    """Rows of a batch with ``_maybe``: may the table hold the row's key?"""
    filtered = {v for v in {b.version for b in buckets} if _has_filter(spark, path, v)}
    rows = [(b.retailer or None, b.category_id or None, b.code, b.version, b.version in filtered) for b in buckets]
    here = spark.createDataFrame(rows, "_r string, _c string, _b string, _version string, _filtered boolean")
    place = [F.nullif(F.col(c), F.lit("")) for c in LAYOUT]
    all_of = lambda tests: reduce(lambda a, b: a & b, tests)
    known = _bucketed(batch, buckets).join(here, all_of([p.eqNullSafe(F.col(c)) for p, c in zip(place, ["_r", "_c", "_b"])]), "left")
    if filtered:
        blocks = reduce(DataFrame.unionByName, [
            spark.read.parquet(f"{path}/keys/version={v}").withColumn("_v", F.lit(v)) for v in sorted(filtered)
        ]).select(*[F.nullif(F.col(c), F.lit("")).alias(f"_at{k}") for k, c in enumerate(LAYOUT)], "_v", "n_blocks", "block", "words")
        where = [*[p.eqNullSafe(F.col(f"_at{k}")) for k, p in enumerate(place)], F.col("_version") == F.col("_v")]
        sizes = blocks.select("_at0", "_at1", "_at2", "_v", "n_blocks").distinct()
        known = known.join(broadcast_if_small(sizes), all_of(where), "left").drop("_at0", "_at1", "_at2", "_v")
        known = known.withColumn("_block", _block(F.col("n_blocks"))).drop("n_blocks")
        known = known.join(broadcast_if_small(blocks.drop("n_blocks"), MOST_BLOCKS), all_of([*where, F.col("_block") == F.col("block")]), "left")
        set_there = F.forall(_bits(), lambda b: F.coalesce(
            F.try_element_at("words", F.shiftright(b, 6)).bitwiseAND(_mask(b)) != 0, F.lit(False)))
        maybe = F.when(F.col("_filtered"), F.coalesce(set_there, F.lit(False)))
    else:
        maybe = F.when(F.col("_filtered"), F.lit(True))
    maybe = F.coalesce(F.when(F.col("_version").isNotNull(), F.coalesce(maybe, F.lit(True))), F.lit(False))
    return known.select(*batch.columns, *LAYOUT[2:], maybe.alias("_maybe"))


def unseen_skus(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """Rows of a batch whose SKU their slice of the table has not shown, as :func:`known_sku_filter` on the whole table.

    Only rows that the filters cannot clear are joined with the table, and only with the buckets that those fall into.
    """
    buckets = current(spark, path)[1]
    if not buckets:
        return batch
    marked = materialise(_marked(spark, path, batch, buckets), "marked")
    maybe = marked.where("_maybe")
    met = {tuple(v or None for v in r) for r in maybe.select(*LAYOUT).distinct().collect()}
    known = _read(spark, path, [b for b in buckets if b.key in met]).select(*TRACKED.fieldNames())
    clear = marked.where("not _maybe").select(*batch.columns)
    return clear.unionByName(known_sku_filter(maybe.select(*batch.columns), known)) if met else clear
