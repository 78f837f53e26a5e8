"""Cases, statuses, quality, response logs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from anaquel import registry as R
from anaquel.operators import aggregates as A
from anaquel.operators.cases import case_grid, classify_cases, grid_responses
from anaquel.operators.dedup import keep_last
from anaquel.operators.normalise import display_name
from anaquel.plans.quality_report import quality_report
from anaquel.session import work_dir
from anaquel.sources.captures import write_run_metrics
from anaquel.sources.dims import dim_category, dim_location
from workload import views as V
from workload.registry import query

STATUS_SQL = (
    "case when exit_code = 0 then 'SUCCESS' when exit_code = 2 or contains(lower(log_text), 'blocked:') then 'BLOCKED' "
    "when exit_code = 4 or contains(lower(log_text), 'store_context_error') then 'STORE_CONTEXT_ERROR' "
    "when exit_code = 5 or contains(lower(log_text), 'network_unavailable:') then 'NETWORK_UNAVAILABLE' "
    "when exit_code = 3 then 'EMPTY' else 'ERROR' end"
)
REPORTED_SQL = r"coalesce(try_cast(nullif(regexp_extract(log_text, 'Productos únicos:\s*(\d+)', 1), '') as int), 0)"
CLASSIFIED = f"{V.CASE_LOG_CTE}, classified as (select *, {STATUS_SQL} as status, {REPORTED_SQL} as reported_products from case_log)"


def classified(spark, sf):
    return classify_cases(V.case_log(spark, sf))


@query("classify_case", f"with {CLASSIFIED} select event_id, exit_code, status from classified")
def classify_case(spark, sf):
    return classified(spark, sf).select("event_id", "exit_code", "status")


@query("reported_products", f"with {CLASSIFIED} select event_id, reported_products from classified")
def reported_products(spark, sf):
    return classified(spark, sf).select("event_id", "reported_products")


@query("failed_cases", f"with {CLASSIFIED} select event_id, status, exit_code from classified where status <> 'SUCCESS'")
def failed_cases(spark, sf):
    return A.failed_cases(classified(spark, sf)).select("event_id", "status", "exit_code")


@query("status_rollup", f"with {CLASSIFIED} select status, count(*) as cases from classified group by 1")
def status_rollup(spark, sf):
    return A.status_rollup(classified(spark, sf))


@query("run_passed", f"with {CLASSIFIED} select bool_and(status = 'SUCCESS') as all_success from classified")
def run_passed(spark, sf):
    return A.run_passed(classified(spark, sf))


LATEST = (
    "latest as (select * from classified qualify row_number() over (partition by retailer_id, category_id order by ts desc, event_id desc) = 1)"
)


def latest_log(spark, sf):
    return keep_last(V.case_log(spark, sf), ["retailer_id", "category_id"], ["ts", "event_id"])


NAME = "case {c} " + " ".join(f"when {V.quote(r.retailer_id)} then {V.quote(r.display_name)}" for r in R.RETAILERS) + " else {c} end"
PLACE = "case {c} " + " ".join(f"when {V.quote(r.retailer_id)} then {V.quote(r.location_id)}" for r in R.RETAILERS) + " end"
GRID_CTE = (
    f"{V.dim_cte('dim_category')}, {V.dim_cte('dim_location')}, "
    f"grid as (select c.retailer_id, {NAME.format(c='c.retailer_id')} as retailer, category_id, department, name as category, subcategory, "
    f"sub_subcategory, location_id, store from dim_category c join dim_location l on l.location_id = {PLACE.format(c='c.retailer_id')})"
)


@query("display_name", f"with {V.CASE_LOG_CTE} select event_id, {NAME.format(c='retailer_id')} as retailer from case_log")
def display(spark, sf):
    return V.case_log(spark, sf).select("event_id", display_name(F.col("retailer_id")).alias("retailer"))


@query(
    "case_grid",
    f"with {GRID_CTE}, {V.CASE_LOG_CTE}, runs as (select retailer_id, category_id, count(*) as runs from case_log group by all) "
    "select g.*, coalesce(runs, 0) as runs from grid g left join runs r on g.retailer_id = r.retailer_id and g.category_id = r.category_id",
)
def case_grid_query(spark, sf):
    """Every configured case with the number of its runs."""
    runs = V.case_log(spark, sf).groupBy("retailer_id", "category_id").agg(F.count("*").alias("runs"))
    grid = case_grid(dim_category(spark), dim_location(spark))
    return grid.join(runs, ["retailer_id", "category_id"], "left").withColumn("runs", F.coalesce("runs", F.lit(0)))


QUALITY_CTE = (
    "quality as (select lower(retailer) as rk, category_id, count(*) as products, count(*) filter (trim(coalesce(sku, '')) <> '') as sku_complete, "
    "count(price_current) as price_current_complete, count(price_regular) as price_regular_complete, "
    "count(*) filter (trim(coalesce(url, '')) <> '') as url_complete, count(*) - count(distinct (sku, url)) as duplicates_sku_url, "
    "count(*) filter (store_context_verified) as store_context_verified from listing group by all)"
)
COUNTS_SQL = ", ".join(f"coalesce(q.{c}, 0) as {c}" for c in A.QUALITY_COUNTS)


@query(
    "case_quality",
    f"with {GRID_CTE}, {V.LISTING_CTE}, {QUALITY_CTE} select g.*, {COUNTS_SQL} from grid g left join quality q "
    "on lower(g.retailer) = q.rk and g.category_id = q.category_id",
)
def case_quality(spark, sf):
    return A.case_quality(case_grid(dim_category(spark), dim_location(spark)), V.listing(spark, sf))


@query(
    "quality_report",
    f"with {GRID_CTE}, {CLASSIFIED}, {LATEST}, {V.LISTING_CTE}, {QUALITY_CTE} "
    "select g.retailer_id, g.retailer, g.category_id, g.location_id, g.store, coalesce(l.status, 'ERROR') as status, l.exit_code, "
    f"coalesce(l.reported_products, 0) as reported_products, {COUNTS_SQL} from grid g "
    "left join latest l on g.retailer_id = l.retailer_id and g.category_id = l.category_id "
    "left join quality q on lower(g.retailer) = q.rk and g.category_id = q.category_id",
)
def quality_report_query(spark, sf):
    grid = case_grid(dim_category(spark), dim_location(spark))
    report = quality_report(grid, latest_log(spark, sf), V.listing(spark, sf))
    return report.select(
        "retailer_id", "retailer", "category_id", "location_id", "store", "status", "exit_code", "reported_products",
        *A.QUALITY_COUNTS,
    )


@query(
    "reconcile_counts",
    f"with {CLASSIFIED}, {LATEST}, {V.LISTING_CTE}, found as (select retailer_id, category_id, count(*) as products from listing group by all) "
    "select coalesce(l.retailer_id, f.retailer_id) as retailer_id, coalesce(l.category_id, f.category_id) as category_id, "
    "coalesce(reported_products, 0) as reported_products, coalesce(products, 0) as products, "
    "coalesce(reported_products, 0) - coalesce(products, 0) as difference from latest l full join found f "
    "on l.retailer_id = f.retailer_id and l.category_id = f.category_id",
)
def reconcile_counts(spark, sf):
    key = ["retailer_id", "category_id"]
    reported = classify_cases(latest_log(spark, sf)).select(*key, "reported_products")
    found = V.listing(spark, sf).groupBy(*key).agg(F.count("*").alias("products"))
    return A.reconcile_counts(reported, found, key)


RESPONSES = {
    "ts": "ts",
    "status": "case event_type when 'error' then 403 when 'signup' then 503 else 200 end",
    "url": (
        "'https://tienda.example/' || case event_type when 'view' then 'Search-UpdateGrid?start=' when 'error' then 'Search-ShowAjax?cgid=' "
        "when 'click' then 'x/Search-UpdateGrid?p=' else 'Product-Variation?pid=' end || cast(event_id as string)"
    ),
    "body": "case when value > 300 then null else props end",
    "read_error": "case when value > 300 then 'body gone' end",
}
RESPONSES_CTE = "responses as (select " + ", ".join(f"{e} as {n}" for n, e in RESPONSES.items()) + " from events)"


def responses(events):
    return events.selectExpr(*[f"{e} as {n}" for n, e in RESPONSES.items()])


@query(
    "response_log",
    f"with {RESPONSES_CTE} select strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, status, url, length(body) as body_length, "
    "case when body is null then read_error end as read_error from responses "
    "where contains(url, 'Search-UpdateGrid') or contains(url, 'Search-ShowAjax')",
)
def response_log(spark, sf):
    out = grid_responses(responses(V.table(spark, sf, "events")))
    return out.withColumns(
        {"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "body_length": F.col("body_length").cast("bigint")}
    )


METRIC = T.StructType(
    [T.StructField("retailer_id", T.StringType()), T.StructField("category_id", T.StringType()),
     T.StructField("status", T.StringType()), T.StructField("runs", T.LongType())]
)


@query(
    "run_metrics",
    f"with {CLASSIFIED} select retailer_id, category_id, status, count(*) as runs from classified group by all",
)
def run_metrics(spark, sf):
    """Run records appended as JSON, successes and failures one after the other, and read back."""
    path = work_dir(spark, "metrics")
    counts = classified(spark, sf).groupBy("retailer_id", "category_id", "status").agg(F.count("*").alias("runs"))
    write_run_metrics(counts.where("status = 'SUCCESS'"), path)
    write_run_metrics(counts.where("status <> 'SUCCESS'"), path)
    return spark.read.schema(METRIC).json(path)
