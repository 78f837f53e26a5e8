"""Slice replacement, unions and orderings of the consolidated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.schema import SEQUENCE_COLUMNS, SLICE
from anaquel.session import broadcast_if_small


SLICE_KEY_COLUMNS = ["_retailer", "_category_id", "_city", "_store_id"]


def slice_key(df: DataFrame) -> dict[str, Column]:
    """The slice of a row; null and '' are the same city or store."""
    columns = [df["retailer"], df["category_id"], F.coalesce(df["city"], F.lit("")), F.coalesce(df["store_id"], F.lit(""))]
    return dict(zip(SLICE_KEY_COLUMNS, columns))


def slice_keys(df: DataFrame) -> DataFrame:
    """Distinct slices of a batch."""
    return df.select(*[c.alias(k) for k, c in slice_key(df).items()]).distinct()


def replace_slice(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows outside the slices that the batch brings; an empty batch removes nothing.

    A batch brings few slices as a rule. Their number is checked, so that the existing rows need
    not be shuffled to find out.
    """
    keys = broadcast_if_small(slice_keys(incoming))
    same = reduce(lambda a, b: a & b, [c.eqNullSafe(keys[k]) for k, c in slice_key(existing).items()])
    return existing.join(keys, same, "left_anti")


def append_batch(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both generations; the incoming one counts as later."""
    return existing.withColumn("_generation", F.lit(0)).unionByName(
        incoming.withColumn("_generation", F.lit(1)), allowMissingColumns=True
    )


def union_retailers(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def known_sku_filter(batch: DataFrame, known: DataFrame, slice_cols: list[str] | None = None) -> DataFrame:
    """Rows whose SKU the slice has not shown before.

    Known keys are made distinct first: a key seen very often is cut to one row per map task.
    """
    keys = [*(slice_cols or SLICE), "sku"]
    return batch.alias("b").join(
        known.select(*keys).distinct().alias("k"),
        reduce(lambda a, b: a & b, [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]),
        "left_anti",
    )


def detail_or_card(details: DataFrame, cards: DataFrame, product_urls: DataFrame, slice_cols: list[str]):
    """Detail rows, and card rows only for slices in which no product URL was found at all."""
    listed = product_urls.select(*slice_cols).distinct()
    return details.unionByName(cards.join(listed, slice_cols, "left_anti"), allowMissingColumns=True)


def recover_gaps(primary: DataFrame, fallbacks: list[tuple[str, DataFrame]], page: list[str]) -> DataFrame:
    """Pages without rows are filled from the first fallback that has them; ``source`` says which."""
    filled = primary.withColumn("source", F.lit("primary"))
    for name, rows in fallbacks:
        have = filled.select(*page).distinct()
        filled = filled.unionByName(
            rows.join(have, page, "left_anti").withColumn("source", F.lit(name)), allowMissingColumns=True
        )
    return filled


def _sorted(df: DataFrame, leading: list[str]) -> DataFrame:
    """Nulls last. The columns after the leading ones settle ties, which also lets the range
    partitioning of the sort split a value that many rows share."""
    ties = [c for c in ["sku", "url", *SEQUENCE_COLUMNS] if c in df.columns]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in leading + ties])


def order_batch(df: DataFrame) -> DataFrame:
    return _sorted(df, ["brand", "product"])


CONSOLIDATED_ORDER = ["retailer", "category_id", "brand", "product"]


def order_consolidated(df: DataFrame) -> DataFrame:
    return _sorted(df, CONSOLIDATED_ORDER)
