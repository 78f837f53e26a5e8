"""Page-sequence analytics over page logs (one row per slice and page, pages numbered from one).

A listing may hold a large share of all pages, so nothing here runs one window over a whole slice.
Neighbouring pages meet by grouping on a shifted page number, firsts and lasts are plain
aggregates joined back on the slice (adaptive execution splits a hot slice in such a join), and
running totals go by blocks of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: Column, out: str, block: Column
) -> DataFrame:
    """Inclusive running total of ``value`` within ``group`` in ``order``.

    ``block`` must not decrease along the order. The total is taken inside each block, and the
    sums of the blocks before are added: the second step sees one row per block. ``df`` is read
    twice, so a dear one should be written first (``session.materialise``).
    """
    tagged = df.withColumn("_block", block)
    sums = tagged.groupBy(*group, "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets, [*group, "_block"])
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_block", "_inside", "_offset")
    )


def page_block(page: str = "page") -> Column:
    return F.floor(F.col(page) / BLOCK)


def new_rows_per_page(rows: DataFrame, slice_cols: list[str], key: Column, page: str = "page") -> DataFrame:
    """Rows of each page, and how many keys first occur there."""
    counted = rows.groupBy(*slice_cols, page).agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("new"))
    first_seen = (
        rows.withColumn("_key", key)
        .where(F.col("_key").isNotNull())
        .groupBy(*slice_cols, "_key")
        .agg(F.min(page).alias(page))
        .groupBy(*slice_cols, page)
        .agg(F.lit(0).cast("bigint").alias("rows"), F.count("*").alias("new"))
    )
    return (
        counted.unionByName(first_seen)
        .groupBy(*slice_cols, page)
        .agg(F.sum("rows").alias("rows"), F.sum("new").alias("new"))
    )


def link_growth(counts: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Turns the link total after each round of loading more into what the round added.

    A total that shrinks adds nothing. Each total also meets the next round under a shifted
    number, so no window is needed.
    """
    here = counts.select(*slice_cols, "page", F.col("links").alias("links"), F.lit(None).cast("bigint").alias("before"))
    after = counts.select(
        *slice_cols, (F.col("page") + 1).alias("page"), F.lit(None).cast("bigint").alias("links"), F.col("links").alias("before")
    )
    return (
        here.unionByName(after)
        .groupBy(*slice_cols, "page")
        .agg(F.max("links").alias("rows"), F.max("before").alias("_before"))
        .where(F.col("rows").isNotNull())
        .select(
            *slice_cols, "page", "rows",
            F.greatest(F.col("rows") - F.coalesce("_before", F.lit(0)), F.lit(0)).alias("new"),
        )
    )


def stale_stop(page_log: DataFrame, slice_cols: list[str], length: int = 2) -> DataFrame:
    """First page that ends ``length`` pages in a row without anything new."""
    spread = (
        page_log.where(F.col("new") == 0)
        .select(*slice_cols, F.explode(F.sequence(F.col("page"), F.col("page") + (length - 1))).alias("page"))
        .groupBy(*slice_cols, "page")
        .agg(F.count("*").alias("_n"))
    )
    return spread.where(F.col("_n") == length).groupBy(*slice_cols).agg(F.min("page").alias("stop_page"))


def keep_visited(page_log: DataFrame, stops: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Pages up to and including the stop page; slices without one stay whole."""
    joined = page_log.join(stops.select(*slice_cols, "stop_page"), slice_cols, "left")
    return joined.where(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page"))).drop("stop_page")


def internal_gaps(page_log: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Empty pages that are followed by a filled one."""
    last = page_log.where(F.col("rows") > 0).groupBy(*slice_cols).agg(F.max("page").alias("_last"))
    return (
        page_log.where(F.col("rows") == 0)
        .join(last, slice_cols)
        .where(F.col("page") < F.col("_last"))
        .select(*slice_cols, "page")
    )


def page_sizes(page_log: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Rows of the first filled page of each slice."""
    return (
        page_log.where(F.col("rows") > 0)
        .groupBy(*slice_cols)
        .agg(F.min_by("rows", "page").alias("page_size"))
    )


def partial_pages(page_log: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Per slice: page size, last partly filled page, and the page that ends the listing after one.

    The listing ends at the first page with nothing new that follows a partly filled page and is
    not itself partly filled.
    """
    sized = page_log.join(page_sizes(page_log, slice_cols), slice_cols)
    partial = (F.col("rows") > 0) & (F.col("rows") < F.col("page_size"))
    marked = sized.withColumn("_partial", partial)
    firsts = marked.groupBy(*slice_cols).agg(
        F.max("page_size").alias("page_size"),
        F.max(F.when(F.col("_partial"), F.col("page"))).alias("partial_page"),
        F.min(F.when(F.col("_partial"), F.col("page"))).alias("_first_partial"),
    )
    quiet = page_log.where(F.col("new") == 0).select(*slice_cols, "page", "rows")
    stops = (
        quiet.join(firsts, slice_cols)
        .where(
            (F.col("page") > F.col("_first_partial"))
            & ~((F.col("rows") > 0) & (F.col("rows") < F.col("page_size")))
        )
        .groupBy(*slice_cols)
        .agg(F.min("page").alias("stop_page"))
    )
    return firsts.drop("_first_partial").join(stops, slice_cols, "left")


def expected_pages(total: Column, page_size: Column) -> Column:
    return F.ceil(F.try_divide(total.cast("double"), page_size.cast("double")))


def page_targets(page_log: DataFrame, totals: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Every page but the last is expected to be full."""
    sized = page_sizes(page_log, slice_cols).join(totals, slice_cols)
    wanted = sized.select(
        *slice_cols, "page_size", expected_pages(F.col("displayed_total"), F.col("page_size")).alias("expected_pages")
    )
    return page_log.join(wanted, slice_cols).withColumn(
        "target_rows", F.when(F.col("page") < F.col("expected_pages"), F.col("page_size"))
    )


def page_gaps(expected: DataFrame, observed: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Pages that should exist and were not seen."""
    wanted = expected.where(F.col("expected_pages") >= 1).select(
        *slice_cols, F.explode(F.sequence(F.lit(1), F.col("expected_pages").cast("int"))).alias("page")
    )
    return wanted.join(observed.select(*slice_cols, "page").distinct(), [*slice_cols, "page"], "left_anti")


def cursor_progress(pages: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Running start of a cursor over ``n_items`` per page, and the page at which it stops.

    The first page's total holds for the listing; an empty page also ends it.
    """
    moved = running_total(pages, slice_cols, ["page"], F.col("n_items"), "next_start", page_block())
    totals = pages.groupBy(*slice_cols).agg(F.coalesce(F.min_by("total", "page"), F.lit(0)).alias("_total"))
    done = (F.col("n_items") == 0) | (F.col("next_start") >= F.col("_total"))
    marked = (
        moved.join(totals, slice_cols)
        .withColumn("start", F.col("next_start") - F.col("n_items"))
        .withColumn("done", done)
    )
    return marked.drop("_total")


def cursor_stop(progress: DataFrame, slice_cols: list[str]) -> DataFrame:
    return progress.where("done").groupBy(*slice_cols).agg(F.min("page").alias("stop_page"))


def first_methods(pages: DataFrame, slice_cols: list[str]) -> DataFrame:
    """What the first page of each slice proved."""
    return pages.where(F.col("page") == 1).select(*slice_cols, F.col("direct_method").alias("_first_method"))


def session_verified(
    pages: DataFrame, slice_cols: list[str], required: bool = True, first: DataFrame | None = None
) -> DataFrame:
    """Store verification carried through a session.

    The first page must prove the store, else the slice fails; later pages without their own
    evidence inherit the first page's method, tagged ``session:``. ``first`` can bring the first
    pages' methods ready-made.
    """
    first = first_methods(pages, slice_cols) if first is None else first
    joined = pages.join(first, slice_cols, "left")
    on_first = F.col("page") == 1
    direct, inherited = F.col("direct_method"), F.col("_first_method")
    if not required:
        return joined.select(
            *[c for c in pages.columns],
            F.lit(True).alias("verified"),
            F.coalesce(direct, F.lit("session:preverified")).alias("page_method"),
            F.coalesce(direct, F.lit("preverified")).alias("row_method"),
            F.lit("OK").alias("status"),
        )
    proved = inherited.isNotNull()
    return joined.select(
        *[c for c in pages.columns],
        proved.alias("verified"),
        F.when(on_first, direct)
        .when(proved, F.coalesce(direct, F.concat(F.lit("session:"), inherited)))
        .alias("page_method"),
        inherited.alias("row_method"),
        F.when(proved, F.lit("OK")).otherwise(F.lit("STORE_CONTEXT_ERROR")).alias("status"),
    )


def short_page_stop(pages: DataFrame, slice_cols: list[str], full_page: int = 20) -> DataFrame:
    """First later page without a next link whose cards do not fill it."""
    ends = (
        (F.col("page") >= 2) & ~F.col("has_next") & (F.col("cards") > 0) & (F.col("cards") < full_page)
    )
    return pages.where(ends).groupBy(*slice_cols).agg(F.min("page").alias("stop_page"))


def target_reached_stop(page_log: DataFrame, totals: DataFrame, slice_cols: list[str]) -> DataFrame:
    """First page after which the collected products reach the displayed total."""
    collected = running_total(page_log, slice_cols, ["page"], F.col("new"), "collected", page_block())
    return (
        collected.join(totals, slice_cols)
        .where(F.col("collected") >= F.col("displayed_total"))
        .groupBy(*slice_cols)
        .agg(F.min("page").alias("stop_page"))
    )


def browse_ranges(totals: DataFrame, rows_per_range: int, total: str = "displayed_total") -> DataFrame:
    """One row per range request that covers a listing: start, end and page number."""
    first, step = F.lit(0).cast("bigint"), F.lit(rows_per_range).cast("bigint")
    starts = F.sequence(first, F.col(total).cast("bigint") - 1, step)
    return totals.where(F.col(total) > 0).select(*totals.columns, F.explode(starts).alias("start")).withColumns(
        {
            "end": F.col("start") + (rows_per_range - 1),
            "page": (F.col("start") / rows_per_range).cast("int") + 1,
        }
    )
