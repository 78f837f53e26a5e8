"""Completeness, quality and coverage aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.text import is_blank
from anaquel.schema import SUMMARY_KEY


def count_nonempty(c: str) -> Column:
    """Values that are neither null nor blank."""
    return F.count_if(~is_blank(F.col(c)))


def slice_summary(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(group or SUMMARY_KEY)).agg(
        F.count("*").alias("products"),
        F.count("sku").alias("sku_complete"),
        F.count("price_current").alias("price_complete"),
        F.count("url").alias("url_complete"),
    )


def extraction_completeness(df: DataFrame, group: list[str]) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count("*").alias("rows"),
        count_nonempty("sku").alias("sku_complete"),
        F.count("price_current").alias("price_complete"),
        F.count("price_regular").alias("regular_price_complete"),
        count_nonempty("url").alias("url_complete"),
    )


QUALITY_COUNTS = [
    "products", "sku_complete", "price_current_complete", "price_regular_complete", "url_complete",
    "duplicates_sku_url", "store_context_verified",
]


def quality_by_case(df: DataFrame) -> DataFrame:
    """Quality counts per lower-cased retailer and category.

    Rows are first grouped by (sku, url) within the case, which gives the duplicates without a
    distinct over a whole case.
    """
    per_key = df.groupBy(F.lower("retailer").alias("retailer_key"), "category_id", "sku", "url").agg(
        F.count("*").alias("n"),
        F.count("price_current").alias("current"),
        F.count("price_regular").alias("regular"),
        F.count_if("store_context_verified").alias("verified"),
    )
    return per_key.groupBy("retailer_key", "category_id").agg(
        F.sum("n").alias("products"),
        F.sum(F.when(~is_blank(F.col("sku")), F.col("n")).otherwise(0)).alias("sku_complete"),
        F.sum("current").alias("price_current_complete"),
        F.sum("regular").alias("price_regular_complete"),
        F.sum(F.when(~is_blank(F.col("url")), F.col("n")).otherwise(0)).alias("url_complete"),
        (F.sum("n") - F.count("*")).alias("duplicates_sku_url"),
        F.sum("verified").alias("store_context_verified"),
    )


def case_quality(cases: DataFrame, observations: DataFrame) -> DataFrame:
    """Every case with its counts; a case without rows keeps zeros."""
    counts = quality_by_case(observations)
    joined = cases.withColumn("retailer_key", F.lower("retailer")).join(
        counts, ["retailer_key", "category_id"], "left"
    )
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in QUALITY_COUNTS]
    return joined.select(*cases.columns, *filled)


def coverage_ratio(collected: Column, displayed: Column) -> Column:
    return F.bround(F.try_divide(collected.cast("double"), displayed.cast("double")), 4)


def status_rollup(cases: DataFrame) -> DataFrame:
    return cases.groupBy("status").agg(F.count("*").alias("cases"))


def run_passed(cases: DataFrame) -> DataFrame:
    return cases.agg(F.bool_and(F.col("status") == "SUCCESS").alias("all_success"))


def failed_cases(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("status") != "SUCCESS")


def unique_products(df: DataFrame, slice_cols: list[str]) -> DataFrame:
    return df.groupBy(*slice_cols).agg(F.count_distinct("sku").alias("unique_products"))


def category_totals(df: DataFrame) -> DataFrame:
    """Totals per category, per retailer and overall; the roll-up runs over the counted categories."""
    counted = df.groupBy("retailer", "category_id").agg(F.count("*").alias("n"))
    return counted.rollup("retailer", "category_id").agg(
        F.sum("n").alias("products"), F.grouping_id().alias("level")
    )


def discovery_counts(urls: DataFrame, cards: DataFrame, rows: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Discovered product URLs, fallback cards and final rows of each slice."""
    parts = [
        frame.select(
            *slice_cols,
            *[F.lit(1 if name == kind else 0).alias(name) for name in ("product_urls", "fallback_cards", "rows")],
        )
        for kind, frame in (("product_urls", urls), ("fallback_cards", cards), ("rows", rows))
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy(*slice_cols).agg(
        *[F.sum(n).alias(n) for n in ("product_urls", "fallback_cards", "rows")]
    )


def reconcile_counts(reported: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """What runs reported against what the table holds, both sides kept."""
    joined = reported.join(found, key, "full")
    claimed = F.coalesce(F.col("reported_products"), F.lit(0))
    held = F.coalesce(F.col("products"), F.lit(0))
    return joined.select(
        *key, claimed.alias("reported_products"), held.alias("products"), (claimed - held).alias("difference")
    )
