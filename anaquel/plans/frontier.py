"""What a listing gave, and which of its pages are still to be captured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.operators.dedup import keep_first, keep_last
from anaquel.operators.normalise import listing_page_url
from anaquel.operators.paging import expected_pages, page_gaps, page_sizes


def page_frontier(
    listings: DataFrame, page_log: DataFrame, slice_cols: list[str], url: str = "url"
) -> DataFrame:
    """Expected pages without rows, with the address to capture each one.

    ``listings`` holds one row per slice: retailer_id, address and displayed total. A listing of
    which no page has rows yet starts at page one.
    """
    sizes = page_sizes(page_log, slice_cols)
    wanted = listings.join(sizes, slice_cols, "left").withColumn(
        "expected_pages",
        F.coalesce(expected_pages(F.col("displayed_total"), F.col("page_size")), F.lit(1)).cast("int"),
    )
    missing = page_gaps(wanted, page_log.where(F.col("rows") > 0), slice_cols)
    addresses = listings.select(*slice_cols, "retailer_id", F.col(url).alias("_url"))
    return missing.join(addresses, slice_cols).select(
        *slice_cols,
        "page",
        listing_page_url(F.col("retailer_id"), F.col("_url"), F.col("page")).alias("page_url"),
    )


def collect_listing(
    rows: DataFrame, stops: DataFrame, slice_cols: list[str], key: Column | str, order: list[str], last: bool = False
) -> DataFrame:
    """Rows of the visited pages, one per key: the first sighting, or the last one."""
    visited = rows.join(stops.select(*slice_cols, "stop_page"), slice_cols, "left").where(
        F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page"))
    )
    keep = keep_last if last else keep_first
    return keep(visited.drop("stop_page"), [*slice_cols, key], order)
