"""Audit of paged listings: where each one ended, what it collected, which pages are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.operators.aggregates import coverage_ratio
from anaquel.operators.paging import (
    internal_gaps,
    keep_visited,
    partial_pages,
    stale_stop,
    target_reached_stop,
)
from anaquel.session import materialise


def stop_pages(page_log: DataFrame, totals: DataFrame, slice_cols: list[str]) -> DataFrame:
    """The earliest of the three ends: nothing new twice, after a partial page, total reached."""
    ends = [
        stale_stop(page_log, slice_cols),
        partial_pages(page_log, slice_cols).select(*slice_cols, "stop_page"),
        target_reached_stop(page_log, totals, slice_cols),
    ]
    union = ends[0].unionByName(ends[1]).unionByName(ends[2])
    return union.groupBy(*slice_cols).agg(F.min("stop_page").alias("stop_page"))


def listing_audit(page_log: DataFrame, totals: DataFrame, slice_cols: list[str]) -> DataFrame:
    """One row per listing. ``page_log`` is read several times, so it should be a table."""
    stops = stop_pages(page_log, totals, slice_cols)
    visited = materialise(keep_visited(page_log, stops, slice_cols), "visited")
    gaps = (
        internal_gaps(visited, slice_cols)
        .groupBy(*slice_cols)
        .agg(F.count("*").alias("gap_pages"), F.min("page").alias("first_gap"), F.max("page").alias("last_gap"))
    )
    partial = partial_pages(visited, slice_cols).select(*slice_cols, "page_size", "partial_page")
    collected = visited.groupBy(*slice_cols).agg(
        F.count("*").alias("pages"), F.sum("rows").alias("rows"), F.sum("new").alias("collected")
    )
    gap_count: Column = F.coalesce(F.col("gap_pages"), F.lit(0))
    return (
        collected.join(partial, slice_cols, "left")
        .join(gaps, slice_cols, "left")
        .join(totals, slice_cols, "left")
        .select(
            *slice_cols,
            "pages",
            "rows",
            "collected",
            "page_size",
            "partial_page",
            gap_count.alias("gap_pages"),
            "first_gap",
            "last_gap",
            (gap_count == 0).alias("listing_exhausted"),
            "displayed_total",
            coverage_ratio(F.col("collected"), F.col("displayed_total")).alias("coverage"),
            F.when(gap_count > 0, F.lit("ERROR")).otherwise(F.lit("OK")).alias("status"),
        )
    )
