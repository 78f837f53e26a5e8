"""Page sequences, gaps, attempts, and the audit of paged listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.urls import browse_url
from anaquel.operators import dedup as D
from anaquel.operators import paging as W
from anaquel.operators.aggregates import coverage_ratio
from anaquel.operators.shape import page_limit
from anaquel.operators.slices import recover_gaps
from anaquel.plans.frontier import collect_listing, page_frontier
from anaquel.plans.listing_audit import listing_audit, stop_pages
from anaquel.session import materialise
from workload import views as V
from workload.registry import query

S = V.SLICE_KEY
LOG, TOTALS = V.PAGE_LOG_CTE, V.TOTALS_CTE


@query("new_rows_per_page", f"with {LOG} select slice, page, rows, new from page_log where rows > 0")
def new_rows_per_page(spark, sf):
    return W.new_rows_per_page(V.page_rows(spark, sf), S, F.col("sku"))


STALE = (
    "stale as (select slice, min(page) as stop_page from (select *, lag(new) over (partition by slice order by page) as p "
    "from page_log) where new = 0 and p = 0 group by slice)"
)


@query("stale_stop", f"with {LOG}, {STALE} select slice, stop_page from stale")
def stale_stop(spark, sf):
    return W.stale_stop(V.page_log(spark, sf), S)


@query(
    "visited_pages",
    f"with {LOG}, {STALE} select l.slice, l.page, l.rows, l.new from page_log l left join stale s on l.slice = s.slice "
    "where s.stop_page is null or l.page <= s.stop_page",
)
def visited_pages(spark, sf):
    log = V.page_log(spark, sf)
    return W.keep_visited(log, W.stale_stop(log, S), S).select("slice", "page", "rows", "new")


@query(
    "internal_gaps",
    f"with {LOG} select slice, page from page_log l where rows = 0 and page < "
    "(select max(page) from page_log m where m.slice = l.slice and m.rows > 0)",
)
def internal_gaps(spark, sf):
    return W.internal_gaps(V.page_log(spark, sf), S)


SIZES = "sizes as (select slice, arg_min(rows, page) filter (rows > 0) as page_size from page_log group by slice having page_size is not null)"
PARTIAL = (
    SIZES
    + ", firsts as (select l.slice, any_value(page_size) as page_size, max(page) filter (rows > 0 and rows < page_size) as partial_page, "
    "min(page) filter (rows > 0 and rows < page_size) as first_partial from page_log l join sizes s on l.slice = s.slice group by l.slice), "
    "partial_stops as (select l.slice, min(page) as stop_page from page_log l join firsts f on l.slice = f.slice "
    "where new = 0 and page > first_partial and not (rows > 0 and rows < page_size) group by l.slice)"
)


@query(
    "partial_pages",
    f"with {LOG}, {PARTIAL} select f.slice, page_size, partial_page, stop_page from firsts f left join partial_stops p on f.slice = p.slice",
)
def partial_pages(spark, sf):
    return W.partial_pages(V.page_log(spark, sf), S)


@query(
    "expected_pages",
    f"with {LOG}, {TOTALS}, {SIZES}, e as (select s.slice, page_size, cast(ceil(displayed_total / page_size) as bigint) as expected_pages "
    "from sizes s join totals t on s.slice = t.slice) "
    "select l.slice, page, expected_pages, case when page < expected_pages then page_size end as target_rows from page_log l join e on l.slice = e.slice",
)
def expected_pages(spark, sf):
    log = V.page_log(spark, sf)
    return W.page_targets(log, V.totals(spark, sf), S).select("slice", "page", "expected_pages", "target_rows")


@query(
    "page_gaps",
    f"with {LOG}, {TOTALS} select slice, cast(p as int) as page from totals, unnest(generate_series(1, displayed_total)) as u(p) "
    "where not exists (select 1 from page_log l where l.slice = totals.slice and l.page = p and l.rows > 0)",
)
def page_gaps(spark, sf):
    expected = V.totals(spark, sf).withColumnRenamed("displayed_total", "expected_pages")
    observed = V.page_events(spark, sf).where("rows > 0")
    return W.page_gaps(expected, observed, S)


CURSOR_TOTAL = "cast(20 + event_id % 30 as bigint)"


@query(
    "cursor_progress",
    f"with {V.PAGES_CTE}, c as (select slice, page, cast(rows as bigint) as n_items, {CURSOR_TOTAL} as total from page_events), "
    "t as (select slice, arg_min(total, page) as first_total from c group by slice) "
    "select c.slice, page, n_items, cast(sum(n_items) over (partition by c.slice order by page) as bigint) as next_start, "
    "cast(sum(n_items) over (partition by c.slice order by page) - n_items as bigint) as start, "
    "n_items = 0 or sum(n_items) over (partition by c.slice order by page) >= first_total as done from c join t on c.slice = t.slice",
)
def cursor_progress(spark, sf):
    pages = V.page_events(spark, sf).selectExpr("slice", "page", "cast(rows as bigint) as n_items", f"{CURSOR_TOTAL} as total")
    return W.cursor_progress(materialise(pages, "cursor"), S).select("slice", "page", "n_items", "next_start", "start", "done")


@query(
    "cursor_stop",
    f"with {V.PAGES_CTE}, c as (select slice, page, rows as n_items, {CURSOR_TOTAL} as total, "
    "sum(rows) over (partition by slice order by page) as reached from page_events), "
    "t as (select slice, arg_min(total, page) as first_total from c group by slice) "
    "select c.slice, min(page) as stop_page from c join t on c.slice = t.slice where n_items = 0 or reached >= first_total group by c.slice",
)
def cursor_stop(spark, sf):
    pages = V.page_events(spark, sf).selectExpr("slice", "page", "cast(rows as bigint) as n_items", f"{CURSOR_TOTAL} as total")
    return W.cursor_stop(W.cursor_progress(materialise(pages, "cursor"), S), S)


METHOD = "case event_type when 'view' then 'category_text' when 'click' then 'browser_state' when 'signup' then 'category_text' end"


@query(
    "session_verified",
    f"with {V.PAGES_CTE}, p as (select slice, page, {METHOD} as direct_method from page_events), "
    "f as (select slice, direct_method as first_method from p where page = 1) "
    "select p.slice, page, direct_method, first_method is not null as verified, "
    "case when page = 1 then direct_method when first_method is not null then coalesce(direct_method, 'session:' || first_method) end as page_method, "
    "first_method as row_method, case when first_method is null then 'STORE_CONTEXT_ERROR' else 'OK' end as status from p join f on p.slice = f.slice",
)
def session_verified(spark, sf):
    pages = V.page_events(spark, sf).selectExpr("slice", "page", f"{METHOD} as direct_method")
    return W.session_verified(materialise(pages, "session"), S)


@query(
    "session_preverified",
    f"with {V.PAGES_CTE}, p as (select slice, page, {METHOD} as direct_method from page_events) "
    "select slice, page, direct_method, true as verified, coalesce(direct_method, 'session:preverified') as page_method, "
    "coalesce(direct_method, 'preverified') as row_method, 'OK' as status from p",
)
def session_preverified(spark, sf):
    pages = V.page_events(spark, sf).selectExpr("slice", "page", f"{METHOD} as direct_method")
    return W.session_verified(pages, S, required=False)


@query(
    "short_page_stop",
    f"with {V.PAGES_CTE} select slice, min(page) as stop_page from page_events "
    "where page >= 2 and event_type = 'error' and cast(floor(value) as int) % 30 between 1 and 19 group by slice",
)
def short_page_stop(spark, sf):
    pages = V.page_events(spark, sf).selectExpr(
        "slice", "page", "cast(floor(value) as int) % 30 as cards", "event_type <> 'error' as has_next"
    )
    return W.short_page_stop(pages, S)


TARGET = (
    "reached as (select *, sum(new) over (partition by slice order by page) as collected from page_log), "
    "target_stops as (select r.slice, min(page) as stop_page from reached r join totals t on r.slice = t.slice "
    "where collected >= displayed_total group by r.slice)"
)


@query("target_reached_stop", f"with {LOG}, {TOTALS}, {TARGET} select slice, stop_page from target_stops")
def target_reached_stop(spark, sf):
    return W.target_reached_stop(V.page_log(spark, sf), V.totals(spark, sf), S)


STOPS = (
    f"{STALE}, {PARTIAL}, {TARGET}, stops as (select slice, min(stop_page) as stop_page from "
    "(select * from stale union all select * from partial_stops union all select * from target_stops) group by slice)"
)


@query("stop_pages", f"with {LOG}, {TOTALS}, {STOPS} select slice, stop_page from stops")
def stop_pages_query(spark, sf):
    return stop_pages(V.page_log(spark, sf), V.totals(spark, sf), S)


@query(
    "listing_audit",
    f"with {LOG}, {TOTALS}, {STOPS}, "
    "v as (select l.* from page_log l left join stops s on l.slice = s.slice where s.stop_page is null or l.page <= s.stop_page), "
    "vs as (select slice, arg_min(rows, page) filter (rows > 0) as page_size, max(page) filter (rows > 0) as last_filled from v group by slice), "
    "a as (select v.slice, count(*) as pages, cast(sum(rows) as bigint) as rows, cast(sum(new) as bigint) as collected, any_value(page_size) as page_size, "
    "max(page) filter (rows > 0 and rows < page_size) as partial_page, "
    "count(*) filter (rows = 0 and page < last_filled) as gap_pages, min(page) filter (rows = 0 and page < last_filled) as first_gap, "
    "max(page) filter (rows = 0 and page < last_filled) as last_gap from v join vs on v.slice = vs.slice group by v.slice) "
    "select a.*, gap_pages = 0 as listing_exhausted, displayed_total, round_even(collected / displayed_total, 4) as coverage, "
    "case when gap_pages > 0 then 'ERROR' else 'OK' end as status from a left join totals t on a.slice = t.slice",
)
def listing_audit_query(spark, sf):
    log = V.page_log(spark, sf)
    return listing_audit(log, V.totals(spark, sf), S)


@query(
    "coverage_ratio",
    f"with {LOG}, {TOTALS}, c as (select slice, sum(new) as collected from page_log group by slice) "
    "select c.slice, cast(collected as bigint) as collected, displayed_total, round_even(collected / displayed_total, 4) as coverage "
    "from c join totals t on c.slice = t.slice",
)
def coverage(spark, sf):
    collected = V.page_log(spark, sf).groupBy("slice").agg(F.sum("new").alias("collected"))
    return collected.join(V.totals(spark, sf), "slice").withColumn(
        "coverage", coverage_ratio(F.col("collected"), F.col("displayed_total"))
    )


@query(
    "page_metrics",
    f"with {LOG}, p as (select slice, page, {METHOD} as direct_method from page_events), "
    "f as (select slice, direct_method as first_method from p where page = 1) "
    "select l.slice, l.page, l.rows, l.new, direct_method is not null as direct_evidence, "
    "case when l.page = 1 then direct_method when first_method is not null then coalesce(direct_method, 'session:' || first_method) end as page_method "
    "from page_log l join p on l.slice = p.slice and l.page = p.page join f on l.slice = f.slice",
)
def page_metrics(spark, sf):
    pages = V.page_events(spark, sf).selectExpr("slice", "page", f"{METHOD} as direct_method")
    methods = W.session_verified(materialise(pages, "session"), S)
    return V.page_log(spark, sf).join(methods, ["slice", "page"]).select(
        "slice", "page", "rows", "new", F.col("direct_method").isNotNull().alias("direct_evidence"), "page_method"
    )


# Attempts: three pages in a row are the attempts at one.
ATTEMPT = "cast(floor((page - 1) / 3) as int) + 1 as page, (page - 1) % 3 + 1 as attempt"
ATTEMPT_CTE = (
    f"{V.PAGES_CTE}, {V.PAGE_ROWS_CTE}, attempts as (select slice, {ATTEMPT}, position, sku, "
    "case when slice like '%7' then null else 4 end as target_rows from page_rows)"
)


def attempts(spark, sf):
    return V.page_rows(spark, sf).selectExpr(
        "slice", ATTEMPT.split(" as page, ")[0] + " as page", "(page - 1) % 3 + 1 as attempt", "position", "sku",
        "case when slice like '%7' then null else 4 end as target_rows",
    )


@query(
    "best_attempt",
    f"with {ATTEMPT_CTE} select slice, page, attempt, sku from attempts "
    "qualify row_number() over (partition by slice, page, sku order by attempt desc, position desc) = 1",
)
def best_attempt(spark, sf):
    return D.best_attempt(attempts(spark, sf), ["slice", "page"]).select("slice", "page", "attempt", "sku")


@query(
    "attempts_needed",
    f"with {ATTEMPT_CTE}, f as (select slice, page, sku, min(attempt) as attempt, max(target_rows) as target_rows from attempts group by all), "
    "n as (select slice, page, attempt, count(*) as n, max(target_rows) as target_rows from f group by all), "
    "r as (select *, sum(n) over (partition by slice, page order by attempt) as reached from n) "
    "select slice, page, min(attempt) filter (reached >= coalesce(target_rows, 1)) as attempts_needed, cast(sum(n) as bigint) as best_rows from r group by all",
)
def attempts_needed(spark, sf):
    return D.attempts_needed(attempts(spark, sf), ["slice", "page"])


@query(
    "recover_gaps",
    f"with {ATTEMPT_CTE}, first_filled as (select slice, page, min(attempt) as attempt from attempts group by all) "
    "select a.slice, a.page, case a.attempt when 1 then 'primary' when 2 then 'previous_page' else 'product_search' end as source, count(*) as rows "
    "from attempts a join first_filled f on a.slice = f.slice and a.page = f.page and a.attempt = f.attempt group by all",
)
def recover(spark, sf):
    rows = materialise(attempts(spark, sf), "attempts")
    found = recover_gaps(
        rows.where("attempt = 1"),
        [("previous_page", rows.where("attempt = 2")), ("product_search", rows.where("attempt = 3"))],
        ["slice", "page"],
    )
    return found.groupBy("slice", "page", "source").agg(F.count("*").alias("rows"))


def ranges_sql(size: int) -> str:
    return (
        f"select slice, displayed_total, s as start, s + {size - 1} as \"end\", cast(s // {size} as int) + 1 as page "
        f"from totals, unnest(generate_series(cast(0 as bigint), displayed_total - 1, {size})) as u(s)"
    )


@query(
    "browse_requests",
    f"with {TOTALS}, r as ({ranges_sql(R.BROWSE_ROWS)}) select *, "
    f"'{R.BROWSE_ENDPOINT}?origin=search_box&start=' || start || '&rows={R.BROWSE_ROWS}&lang=es&scope=desktop&channel=tl&region=NACIONAL"
    "&browseField=categoryIds&browseValue=' || substr(slice, 2) as url from r",
)
def browse_requests(spark, sf):
    ranges = W.browse_ranges(V.totals(spark, sf), R.BROWSE_ROWS)
    return ranges.withColumn(
        "url", browse_url(F.expr("substring(slice, 2)"), F.col("start"), F.lit(R.BROWSE_ROWS))
    )


@query("range_requests", f"with {TOTALS} {ranges_sql(R.RANGE_ROWS)}")
def range_requests(spark, sf):
    return W.browse_ranges(V.totals(spark, sf), R.RANGE_ROWS)


@query("page_limit_unset", f"with {V.PAGES_CTE} select slice, page, event_id from page_events")
def page_limit_unset(spark, sf):
    """A limit of zero stands for all pages."""
    return page_limit(V.page_events(spark, sf), 0, "page").select("slice", "page", "event_id")


@query(
    "link_growth",
    f"with {V.PAGES_CTE}, c as (select slice, page, cast(floor(value) as bigint) as links from page_events) "
    "select slice, page, links as rows, greatest(links - coalesce(lag(links) over (partition by slice order by page), 0), 0) as new from c",
)
def link_growth(spark, sf):
    counts = V.page_events(spark, sf).selectExpr("slice", "page", "cast(floor(value) as bigint) as links")
    return W.link_growth(materialise(counts, "links"), S)


@query(
    "stale_stop_links",
    f"with {V.PAGES_CTE}, c as (select slice, page, cast(floor(value) as bigint) as links from page_events), "
    "g as (select slice, page, greatest(links - coalesce(lag(links) over (partition by slice order by page), 0), 0) as new from c), "
    "p as (select *, lag(new) over (partition by slice order by page) as before from g) "
    "select slice, min(page) as stop_page from p where new = 0 and before = 0 group by slice",
)
def stale_stop_links(spark, sf):
    """End of loading more: the link total has not grown twice in a row."""
    counts = V.page_events(spark, sf).selectExpr("slice", "page", "cast(floor(value) as bigint) as links")
    return W.stale_stop(W.link_growth(materialise(counts, "links"), S), S)


# Products of a page are links with an address or cards with only a code.
FOUND = ["case when position = 1 then 'u' || sku end as url", "case when position > 1 then sku end as code"]


@query(
    "stale_stop_discovery",
    f"with {V.PAGES_CTE}, {V.PAGE_ROWS_CTE}, found as (select slice, page, coalesce('url ' || url, 'code ' || code) as k "
    f"from (select slice, page, {', '.join(FOUND)} from page_rows)), "
    "firsts as (select slice, k, min(page) as page from found group by all), "
    "log as (select p.slice, p.page, count(f.k) as new from page_events p left join firsts f on p.slice = f.slice and p.page = f.page group by all), "
    "b as (select *, lag(new) over (partition by slice order by page) as before from log) "
    "select slice, min(page) as stop_page from b where new = 0 and before = 0 group by slice",
)
def stale_stop_discovery(spark, sf):
    """Neither new addresses nor new codes on two pages in a row; pages without rows count."""
    events = materialise(V.page_events(spark, sf), "page-events")
    found = V.rows_of_pages(events).selectExpr("slice", "page", *FOUND)
    key = F.coalesce(F.concat(F.lit("url "), "url"), F.concat(F.lit("code "), "code"))
    new = W.new_rows_per_page(found, S, key)
    empty = events.where("rows = 0").select("slice", "page", F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("new"))
    return W.stale_stop(new.unionByName(empty), S)


@query(
    "collect_listing",
    f"with {LOG}, {STALE}, v as (select r.* from page_rows r left join stale s on r.slice = s.slice where s.stop_page is null or r.page <= s.stop_page) "
    "select slice, page, position, sku from v qualify row_number() over (partition by slice, sku order by page, position) = 1",
)
def collect_listing_query(spark, sf):
    events = materialise(V.page_events(spark, sf), "page-events")
    stops = W.stale_stop(V.page_log(spark, sf), S)
    rows = V.rows_of_pages(events).withColumn("position", F.col("position").cast("bigint"))
    return collect_listing(rows, stops, S, "sku", ["page", "position"])


LISTING_RETAILER = (
    "case cast(substring(t.slice, 2) as int) % 3 when 0 then 'walmart' when 1 then 'farmacias-del-ahorro' else 'farmacias-san-pablo' end as retailer_id"
)
LISTING_URL = "'https://x.example/c/' || t.slice as url"


@query(
    "page_frontier",
    f"with {LOG}, {TOTALS}, {SIZES}, l as (select t.slice, displayed_total, {LISTING_RETAILER}, {LISTING_URL}, "
    "cast(coalesce(ceil(displayed_total / page_size), 1) as int) as expected from totals t left join sizes s on t.slice = s.slice) "
    "select slice, cast(p as int) as page, url || case when p = 1 then '' else case retailer_id when 'walmart' then '?page=' when 'farmacias-del-ahorro' then '?p=' else '?currentPage=' end || p end as page_url "
    "from l, unnest(generate_series(1, expected)) as u(p) where not exists (select 1 from page_log g where g.slice = l.slice and g.page = p and g.rows > 0)",
)
def page_frontier_query(spark, sf):
    listings = V.totals(spark, sf).alias("t").selectExpr("t.slice", "displayed_total", LISTING_RETAILER, LISTING_URL)
    return page_frontier(listings, V.page_log(spark, sf), S)
