"""Table jobs: shape, slices, dedup, unions, orderings, aggregates, consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from anaquel import registry as R
from anaquel.operators import aggregates as A
from anaquel.operators import dedup as D
from anaquel.operators import shape as P
from anaquel.operators import slices as J
from anaquel.plans.category_batch import category_batch
from anaquel.plans.consolidate import consolidate
from anaquel.schema import OBSERVATION_COLUMNS, SLICE, SUMMARY_KEY
from anaquel.session import materialise, work_dir
from anaquel.sources.captures import read_summary_csv, write_summary_csv
from anaquel.sources.consolidated import merge_batch, scan_consolidated, scan_summary, write_consolidated
from anaquel.sources.dims import dim_category, dim_location
from anaquel.sources.known_keys import refresh_known_keys, unseen_skus
from workload import views as V
from workload.registry import edge, query, text_time

RESULT = ["retailer", "category_id", "city", "store", "store_id", "sku", "product", "price_current", "price_regular", "url"]
RESULT_SQL = (
    "retailer, category_id, city, store, store_id, sku, product, cast(price_current as double) as price_current, "
    "cast(price_regular as double) as price_regular, url"
)
SEQ = ["run_id", "page_number", "attempt", "position"]


def order_sql(direction: str, first: list[str] = SEQ) -> str:
    """The same total order as the jobs: the sequence, then every other column."""
    rest = [c for c in V.LISTING if c not in first]
    return ", ".join(f"{c} {direction} nulls last" for c in first + rest)


def picked(source: str, keys: str, direction: str, columns: str = RESULT_SQL, first: list[str] = SEQ) -> str:
    return (
        f"select {columns} from {source} "
        f"qualify row_number() over (partition by {keys} order by {order_sql(direction, first)}) = 1"
    )


@query(
    "conform_schema",
    f"with {V.LISTING_CTE} select "
    + ", ".join(
        f"{text_time(c)} as {c}" if c == "scrape_timestamp"
        else f"cast({c} as double) as {c}" if c.startswith("price_c") or c.startswith("price_reg")
        else "cast(null as string) as promotion" if c == "promotion"
        else c
        for c in OBSERVATION_COLUMNS
    )
    + " from listing",
)
def conform_schema(spark, sf):
    rows = V.listing(spark, sf).drop("promotion", "department").withColumn("extra", F.lit(1))
    return edge(P.conform_schema(rows, keep_sequence=False))


@query(
    "stamp_category",
    f"with {V.LISTING_CTE}, {V.dim_cte('dim_category')} "
    "select l.retailer_id, l.category_id, d.department, d.name as category, d.subcategory, d.sub_subcategory, "
    "l.sku, l.run_id, l.page_number from listing l join dim_category d "
    "on l.retailer_id = d.retailer_id and l.category_id = d.category_id",
)
def stamp_category(spark, sf):
    return P.stamp_category(V.listing(spark, sf), dim_category(spark)).select(
        "retailer_id", "category_id", "department", "category", "subcategory", "sub_subcategory", "sku", "run_id",
        "page_number",
    )


@query(
    "stamp_location",
    f"with {V.LISTING_CTE}, {V.dim_cte('dim_location')} "
    "select l.location_id, d.city, d.state, d.postal_code, d.store, d.store_id, l.sku, l.run_id, l.page_number "
    "from listing l join dim_location d on l.location_id = d.location_id",
)
def stamp_location(spark, sf):
    return P.stamp_location(V.listing(spark, sf), dim_location(spark)).select(
        "location_id", "city", "state", "postal_code", "store", "store_id", "sku", "run_id", "page_number"
    )


@query(
    "enrich_dims_orphans",
    f"with {V.LISTING_CTE}, {V.dim_cte('dim_category')}, {V.dim_cte('dim_location')} "
    "select 'category' as kind, retailer_id || '/' || category_id as missing, count(*) as orphan_rows from listing l "
    "where not exists (select 1 from dim_category d where d.retailer_id = l.retailer_id and d.category_id = l.category_id) "
    "group by all union all "
    "select 'location', location_id, count(*) from listing l "
    "where not exists (select 1 from dim_location d where d.location_id = l.location_id) group by all",
)
def enrich_dims_orphans(spark, sf):
    rows = V.listing(spark, sf)
    categories = P.unknown_categories(rows, dim_category(spark)).select(
        F.lit("category").alias("kind"), F.concat_ws("/", "retailer_id", "category_id").alias("missing"), "orphan_rows"
    )
    places = P.unknown_locations(rows, dim_location(spark)).select(
        F.lit("location").alias("kind"), F.col("location_id").alias("missing"), "orphan_rows"
    )
    return categories.unionByName(places)


def reason_sql() -> str:
    cases = []
    for r in R.RETAILERS:
        gaps = " ".join(
            f"when {c} is null then '{c}'" if c == "price_current" else f"when trim(coalesce({c}, '')) = '' then '{c}'"
            for c in r.required
        )
        cases.append(f"when '{r.retailer_id}' then case {gaps} end")
    return "case retailer_id " + " ".join(cases) + " end"


@query(
    "require_fields",
    f"with {V.LISTING_CTE} select retailer_id, sku, product, url, cast(price_current as double) as price_current, run_id "
    f"from listing where {reason_sql()} is null",
)
def require_fields(spark, sf):
    kept = P.require_fields(V.listing(spark, sf))
    return edge(kept.select("retailer_id", "sku", "product", "url", "price_current", "run_id"))


@query(
    "rejected_rows",
    f"with {V.LISTING_CTE}, marked as (select *, {reason_sql()} as reject_reason from listing) "
    "select retailer_id, reject_reason, count(*) as rejected from marked where reject_reason is not null group by all",
)
def rejected_rows(spark, sf):
    return P.rejected_rows(V.listing(spark, sf)).groupBy("retailer_id", "reject_reason").agg(
        F.count("*").alias("rejected")
    )


@query(
    "valid_price",
    f"with {V.LISTING_CTE} select {RESULT_SQL} from listing where price_current > 0",
)
def valid_price(spark, sf):
    return edge(P.valid_price(V.listing(spark, sf)).select(*RESULT))


@query(
    "page_limit",
    f"with {V.LISTING_CTE} select {RESULT_SQL}, page_number from listing where page_number <= 3",
)
def page_limit(spark, sf):
    return edge(P.page_limit(V.listing(spark, sf), 3).select(*RESULT, "page_number"))


# Slices.
@query(
    "replace_slice",
    f"with {V.BATCHES_CTE} select {RESULT_SQL} from existing e where not exists (select 1 from incoming i "
    "where i.retailer = e.retailer and i.category_id = e.category_id and coalesce(i.city, '') = coalesce(e.city, '') "
    "and coalesce(i.store_id, '') = coalesce(e.store_id, ''))",
)
def replace_slice(spark, sf):
    existing, incoming = V.batches(spark, sf)
    return edge(J.replace_slice(existing, incoming).select(*RESULT))


@query(
    "append_batch",
    f"with {V.BATCHES_CTE} select 0 as generation, retailer, count(*) as n from existing group by all "
    "union all select 1, retailer, count(*) from incoming group by all",
)
def append_batch(spark, sf):
    existing, incoming = V.batches(spark, sf)
    return J.append_batch(existing, incoming).groupBy(F.col("_generation").alias("generation"), "retailer").agg(
        F.count("*").alias("n")
    )


@query(
    "union_retailers",
    f"with {V.LISTING_CTE} select retailer, category_id, page_number, sku, cast(price_current as double) as price_current "
    "from listing",
)
def union_retailers(spark, sf):
    rows = materialise(V.listing(spark, sf).select(*RESULT, "page_number"), "listing", ("retailer",))
    names = [r.display_name for r in R.RETAILERS]
    parts = [rows.where(F.col("retailer") == n) for n in names]
    parts[0] = parts[0].drop("store", "store_id")
    return edge(
        J.union_retailers(parts).select("retailer", "category_id", "page_number", "sku", "price_current")
    )


@query(
    "known_sku_filter",
    f"with {V.BATCHES_CTE} select {RESULT_SQL} from incoming i where not exists (select 1 from existing e "
    "where e.retailer is not distinct from i.retailer and e.category_id is not distinct from i.category_id "
    "and e.city is not distinct from i.city and e.sku is not distinct from i.sku)",
)
def known_sku_filter(spark, sf):
    existing, incoming = V.batches(spark, sf)
    return edge(J.known_sku_filter(incoming, existing, ["retailer", "category_id", "city"]).select(*RESULT))


@query(
    "unseen_skus_by_filter",
    f"with {V.BATCHES_CTE} select {RESULT_SQL} from incoming i where not exists (select 1 from existing e "
    "where e.retailer is not distinct from i.retailer and e.category_id is not distinct from i.category_id "
    "and e.city is not distinct from i.city and e.store_id is not distinct from i.store_id and e.sku is not distinct from i.sku)",
)
def unseen_skus_by_filter(spark, sf):
    """The same through the table and the filters beside it."""
    existing, incoming = V.batches(spark, sf)
    path = work_dir(spark, "known")
    write_consolidated(consolidate(existing.where("false"), existing), path)
    refresh_known_keys(spark, path)
    return edge(unseen_skus(spark, path, incoming).select(*RESULT))


@query(
    "detail_or_card",
    f"with {V.LISTING_CTE}, k as (select *, retailer || '/' || category_id || '/' || page_number || '/' || coalesce(store_id, '-') as s "
    "from listing), "
    "listed as (select distinct s from k where url is not null and price_current > 50000) "
    "select s, sku, 'detail' as source from k where url is not null and price_current > 50000 "
    "union all select s, sku, 'card' from k where not (url is not null and coalesce(price_current, 0) > 50000) "
    "and s not in (select s from listed)",
)
def detail_or_card(spark, sf):
    store = F.coalesce("store_id", F.lit("-"))
    rows = V.listing(spark, sf).withColumn("s", F.concat_ws("/", "retailer", "category_id", "page_number", store))
    is_detail = F.col("url").isNotNull() & (F.coalesce("price_current", F.lit(0)) > 50000)
    details = rows.where(is_detail).select("s", "sku", F.lit("detail").alias("source"))
    other = rows.where(~is_detail).select("s", "sku", F.lit("card").alias("source"))
    return J.detail_or_card(details, other, details, ["s"])


@query(
    "order_batch",
    f"with {V.LISTING_CTE} select {RESULT_SQL}, brand from listing order by brand nulls last, product nulls last",
)
def order_batch(spark, sf):
    return edge(J.order_batch(V.listing(spark, sf).select(*RESULT, "brand")))


@query(
    "order_consolidated",
    f"with {V.LISTING_CTE} select {RESULT_SQL}, brand from listing "
    "order by retailer nulls last, category_id nulls last, brand nulls last, product nulls last",
)
def order_consolidated(spark, sf):
    return edge(J.order_consolidated(V.listing(spark, sf).select(*RESULT, "brand")))


# Dedup.
@query(
    "dedup_keep_first",
    f"with {V.LISTING_CTE} " + picked("listing", "retailer, category_id, city, store_id, sku", "asc"),
)
def dedup_keep_first(spark, sf):
    return edge(D.dedup_keep_first(V.listing(spark, sf), SLICE).select(*RESULT))


@query(
    "first_page_rows",
    f"with {V.LISTING_CTE} select {RESULT_SQL}, page_number from listing "
    "qualify rank() over (partition by retailer, category_id, city, store_id, sku order by page_number) = 1",
)
def first_page_rows(spark, sf):
    return edge(D.first_page_rows(V.listing(spark, sf), SLICE).select(*RESULT, "page_number"))


@query(
    "dedup_keep_last",
    f"with {V.LISTING_CTE} "
    + picked("listing", "retailer, category_id, city, store_id, coalesce(nullif(sku, ''), url)", "desc"),
)
def dedup_keep_last(spark, sf):
    return edge(D.dedup_keep_last(V.listing(spark, sf), SLICE).select(*RESULT))


@query(
    "dedup_sku_url",
    f"with {V.LISTING_CTE} " + picked("listing", "retailer, category_id, sku, url", "desc"),
)
def dedup_sku_url(spark, sf):
    return edge(D.dedup_sku_url(V.listing(spark, sf), ["retailer", "category_id"]).select(*RESULT))


@query(
    "dedup_consolidated",
    f"with {V.LISTING_CTE} " + picked("listing", "retailer, category_id, city, store_id, sku, url", "desc"),
)
def dedup_consolidated(spark, sf):
    return edge(D.dedup_consolidated(V.listing(spark, sf)).select(*RESULT))


@query(
    "count_duplicates",
    f"with {V.LISTING_CTE}, g as (select retailer, category_id, sku, url, count(*) as n from listing group by all) "
    "select retailer, category_id, cast(sum(n) as bigint) as rows, cast(sum(n - 1) as bigint) as duplicates_sku_url "
    "from g group by all",
)
def count_duplicates(spark, sf):
    return D.count_duplicates(V.listing(spark, sf), ["retailer", "category_id"])


@query(
    "distinct_urls",
    f"with {V.LISTING_CTE} select retailer, category_id, url, min(run_id) as first_seen from listing group by all",
)
def distinct_urls(spark, sf):
    return D.distinct_urls(V.listing(spark, sf), ["retailer", "category_id"], "run_id")


# Aggregates.
SUMMARY_SQL = (
    "count(*) as products, count(sku) as sku_complete, count(price_current) as price_complete, count(url) as url_complete"
)


@query(
    "slice_summary",
    f"with {V.LISTING_CTE} select {', '.join(SUMMARY_KEY)}, {SUMMARY_SQL} from listing group by {', '.join(SUMMARY_KEY)}",
)
def slice_summary(spark, sf):
    return A.slice_summary(V.listing(spark, sf))


@query(
    "count_nonempty",
    f"with {V.LISTING_CTE} select retailer, count(*) filter (trim(coalesce(sku, '')) <> '') as sku_nonempty, "
    "count(*) filter (trim(coalesce(url, '')) <> '') as url_nonempty, "
    "count(*) filter (trim(coalesce(city, '')) <> '') as city_nonempty from listing group by 1",
)
def count_nonempty(spark, sf):
    return V.listing(spark, sf).groupBy("retailer").agg(
        *[A.count_nonempty(c).alias(f"{c}_nonempty") for c in ("sku", "url", "city")]
    )


@query(
    "extraction_completeness",
    f"with {V.LISTING_CTE} select retailer, category_id, count(*) as rows, "
    "count(*) filter (trim(coalesce(sku, '')) <> '') as sku_complete, count(price_current) as price_complete, "
    "count(price_regular) as regular_price_complete, count(*) filter (trim(coalesce(url, '')) <> '') as url_complete "
    "from listing group by all",
)
def extraction_completeness(spark, sf):
    return A.extraction_completeness(V.listing(spark, sf), ["retailer", "category_id"])


@query(
    "unique_products",
    f"with {V.LISTING_CTE} select retailer, category_id, city, store_id, count(distinct sku) as unique_products "
    "from listing group by all",
)
def unique_products(spark, sf):
    return A.unique_products(V.listing(spark, sf), SLICE)


@query(
    "category_totals",
    f"with {V.LISTING_CTE} select retailer, category_id, count(*) as products, "
    "cast(grouping(retailer) * 2 + grouping(category_id) as bigint) as level from listing "
    "group by rollup (retailer, category_id)",
)
def category_totals(spark, sf):
    return A.category_totals(V.listing(spark, sf))


@query(
    "discovery_counts",
    f"with {V.LISTING_CTE} select retailer, category_id, cast(count(distinct url) as bigint) as product_urls, "
    "count(*) filter (url is null) as fallback_cards, count(*) filter (price_current is not null) as rows "
    "from listing group by all",
)
def discovery_counts(spark, sf):
    rows = V.listing(spark, sf)
    key = ["retailer", "category_id"]
    urls = D.distinct_urls(rows.where("url is not null"), key, "run_id")
    out = A.discovery_counts(urls, rows.where("url is null"), rows.where("price_current is not null"), key)
    return out.select(*key, *[F.col(c).cast("bigint") for c in ("product_urls", "fallback_cards", "rows")])


# Consolidation.
CONSOLIDATED_CTE = (
    V.BATCHES_CTE
    + ", kept as (select *, 0 as generation from existing e where not exists (select 1 from incoming i "
    "where i.retailer = e.retailer and i.category_id = e.category_id and coalesce(i.city, '') = coalesce(e.city, '') "
    "and coalesce(i.store_id, '') = coalesce(e.store_id, '')) union all select *, 1 from incoming), "
    "consolidated as ("
    + picked("kept", "retailer, category_id, city, store_id, sku, url", "desc", "*", ["generation", *SEQ])
    + ")"
)


@query("consolidate", f"with {CONSOLIDATED_CTE} select {RESULT_SQL} from consolidated")
def consolidate_batch(spark, sf):
    existing, incoming = V.batches(spark, sf)
    return edge(consolidate(existing, incoming).select(*RESULT))


@query(
    "consolidate_summary",
    f"with {CONSOLIDATED_CTE} select {', '.join(SUMMARY_KEY)}, {SUMMARY_SQL} from consolidated "
    f"group by {', '.join(SUMMARY_KEY)}",
)
def consolidate_summary(spark, sf):
    existing, incoming = V.batches(spark, sf)
    return A.slice_summary(consolidate(existing, incoming))


@query("consolidated_table", f"with {CONSOLIDATED_CTE} select {RESULT_SQL} from consolidated")
def consolidated_table(spark, sf):
    """The same through the table: fresh start, one batch merged, read back."""
    return edge(scan_consolidated(spark, merged_table(spark, sf)).select(*RESULT))


def merged_table(spark, sf):
    existing, incoming = V.batches(spark, sf)
    path = work_dir(spark, "consolidated")
    # The first generation keeps its duplicates apart by key already.
    write_consolidated(consolidate(existing.where("false"), existing), path)
    merge_batch(spark, path, incoming)
    return path


@query(
    "consolidated_table_summary",
    f"with {CONSOLIDATED_CTE} select {', '.join(SUMMARY_KEY)}, {SUMMARY_SQL} from consolidated group by {', '.join(SUMMARY_KEY)}",
)
def consolidated_table_summary(spark, sf):
    """The summary that commits keep beside the table."""
    return scan_summary(spark, merged_table(spark, sf))


@query(
    "category_batch",
    f"with {V.LISTING_CTE}, {V.dim_cte('dim_category')}, {V.dim_cte('dim_location')}, "
    f"full_rows as (select * from listing where {reason_sql()} is null), "
    "b as (select l.retailer, d.department, d.name as category, d.subcategory, d.sub_subcategory, l.category_id, "
    "o.city, o.state, o.postal_code, o.store, o.store_id, l.sku, l.url, l.product, l.brand, l.price_current, "
    "l.price_regular, l.scrape_timestamp, l.pickup_available, l.store_context_verified, l.price_raw, l.run_id, "
    "l.page_number, l.attempt, l.position from full_rows l "
    "join dim_category d on l.retailer_id = d.retailer_id and l.category_id = d.category_id "
    "join dim_location o on l.location_id = o.location_id) "
    "select retailer, department, category, subcategory, category_id, city, postal_code, store, store_id, sku, url, "
    "product, cast(price_current as double) as price_current, cast(price_regular as double) as price_regular from b "
    "qualify row_number() over (partition by retailer, category_id, city, store_id, sku, url order by run_id desc nulls last, "
    "page_number desc nulls last, attempt desc nulls last, position desc nulls last, scrape_timestamp desc nulls last, "
    "price_current desc nulls last, price_regular desc nulls last, pickup_available desc nulls last, "
    "store_context_verified desc nulls last, price_raw desc nulls last) = 1",
)
def category_batch_query(spark, sf):
    batch, _ = category_batch(V.listing(spark, sf), dim_category(spark), dim_location(spark))
    return edge(
        batch.select(
            "retailer", "department", "category", "subcategory", "category_id", "city", "postal_code", "store",
            "store_id", "sku", "url", "product", "price_current", "price_regular",
        )
    )


@query(
    "category_batch_rejects",
    f"with {V.LISTING_CTE}, {V.dim_cte('dim_category')}, {V.dim_cte('dim_location')}, "
    f"marked as (select *, {reason_sql()} as missing from listing), "
    "judged as (select l.*, coalesce(l.missing, case when d.category_id is null then 'unknown category' "
    "when o.location_id is null then 'unknown location' end) as reject_reason from marked l "
    "left join dim_category d on l.retailer_id = d.retailer_id and l.category_id = d.category_id "
    "left join dim_location o on l.location_id = o.location_id) "
    "select retailer_id, category_id, location_id, reject_reason, count(*) as rows from judged where reject_reason is not null group by all",
)
def category_batch_rejects(spark, sf):
    """What a batch leaves out, by reason and key."""
    _, rejected = category_batch(V.listing(spark, sf), dim_category(spark), dim_location(spark))
    return rejected.groupBy("retailer_id", "category_id", "location_id", "reject_reason").agg(F.count("*").alias("rows"))


SUMMARY_TYPES = T.StructType(
    [T.StructField(c, T.StringType()) for c in SUMMARY_KEY]
    + [T.StructField(c, T.LongType()) for c in ("products", "sku_complete", "price_complete", "url_complete")]
)


@query(
    "summary_csv",
    f"with {V.LISTING_CTE} select {', '.join(SUMMARY_KEY)}, {SUMMARY_SQL} from listing group by {', '.join(SUMMARY_KEY)}",
)
def summary_csv(spark, sf):
    """Summary written as CSV with a header and read back."""
    path = work_dir(spark, "summary")
    write_summary_csv(A.slice_summary(V.listing(spark, sf)), path)
    return read_summary_csv(spark, path, SUMMARY_TYPES)
