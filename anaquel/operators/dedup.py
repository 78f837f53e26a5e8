"""Deduplication with an explicit order.

``row_number() = 1`` lets Spark cut every group to one row per map task before the shuffle
(WindowGroupLimit), so a key that holds a large share of the rows does not reach one task whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.schema import CONSOLIDATED_KEY, SEQUENCE_COLUMNS
from anaquel.session import bound_splits


def _total_order(df: DataFrame, order: list[str], last: bool) -> list[Column]:
    """The given order, ties broken by all other columns: the result never depends on partitioning."""
    named = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in named]
    return [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_last() for c in named + rest]


def keep_one(df: DataFrame, keys: list[Column | str], order: list[str], last: bool) -> DataFrame:
    # The cut sorts whole rows in the task that scans them.
    bound_splits(df.sparkSession)
    window = Window.partitionBy(*keys).orderBy(*_total_order(df, order, last))
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: list[Column | str], order: list[str] | None = None) -> DataFrame:
    return keep_one(df, keys, order or SEQUENCE_COLUMNS, last=False)


def keep_last(df: DataFrame, keys: list[Column | str], order: list[str] | None = None) -> DataFrame:
    return keep_one(df, keys, order or SEQUENCE_COLUMNS, last=True)


def dedup_in_page(df: DataFrame, page: list[str], href: str = "href") -> DataFrame:
    """First card per link of a page; cards without a link go by code, then by their whole text."""
    link = F.nullif(F.col(href), F.lit(""))
    if {"code", "text"} <= set(df.columns):
        link = F.coalesce(link, F.nullif(F.col("code"), F.lit("")), F.col("text"))
    return keep_first(df, [*page, link], ["position"])


def dedup_keep_first(df: DataFrame, slice_cols: list[str]) -> DataFrame:
    return keep_first(df, [*slice_cols, "sku"])


def first_page_rows(df: DataFrame, slice_cols: list[str], key: str = "sku", page: str = "page_number") -> DataFrame:
    """Rows on the first page that shows their key; what later pages repeat is dropped.

    All rows of that page stay, however many, so this is a join with one row per key rather than
    a window: adaptive execution can split a hot key's rows.
    """
    keys = [*slice_cols, key]
    first = df.groupBy(*keys).agg(F.min(page).alias("_page"))
    first = first.withColumnsRenamed({c: f"_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return df.join(first, reduce(lambda a, b: a & b, same) & (F.col(page) == F.col("_page")), "left_semi")


def dedup_keep_last(df: DataFrame, slice_cols: list[str]) -> DataFrame:
    return keep_last(df, [*slice_cols, F.coalesce(F.nullif(F.col("sku"), F.lit("")), F.col("url"))])


def dedup_sku_url(df: DataFrame, slice_cols: list[str]) -> DataFrame:
    return keep_last(df, [*slice_cols, "sku", "url"])


def dedup_consolidated(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    return keep_last(df, CONSOLIDATED_KEY, order)


def count_duplicates(df: DataFrame, group: list[str], key: list[str] | None = None) -> DataFrame:
    """Rows beyond the first per key, nulls counting as a value."""
    pairs = df.groupBy(*group, *(key or ["sku", "url"])).agg(F.count("*").alias("_n"))
    return pairs.groupBy(*group).agg(
        F.sum("_n").alias("rows"), (F.sum("_n") - F.count("*")).alias("duplicates_sku_url")
    )


def distinct_urls(df: DataFrame, slice_cols: list[str], seq: str = "position") -> DataFrame:
    """Distinct product URLs of a slice with the place where each was first seen."""
    return df.groupBy(*slice_cols, "url").agg(F.min(seq).alias("first_seen"))


def attempts_needed(attempt_rows: DataFrame, page: list[str], key: str = "sku", target: str = "target_rows"):
    """Per page: the first attempt at which the union of attempts reaches the target.

    Without a target any row is enough. Keys are first reduced to the attempt that saw them
    first, so the running count goes over one row per attempt.
    """
    counts = (
        attempt_rows.groupBy(*page, key)
        .agg(F.min("attempt").alias("attempt"), F.max(target).alias(target))
        .groupBy(*page, "attempt")
        .agg(F.count(key).alias("_new"), F.max(target).alias(target))
    )
    running = F.sum("_new").over(
        Window.partitionBy(*page).orderBy("attempt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reached = running >= F.coalesce(F.col(target), F.lit(1))
    return (
        counts.withColumn("_attempt", F.when(reached, F.col("attempt")))
        .groupBy(*page)
        .agg(F.min("_attempt").alias("attempts_needed"), F.sum("_new").alias("best_rows"))
    )


def best_attempt(attempt_rows: DataFrame, page: list[str], key: str = "sku") -> DataFrame:
    """Union of a page's attempts, the last one winning per key."""
    return keep_last(attempt_rows, [*page, key], ["attempt", "position"])
