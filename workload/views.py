"""The benchmark tables seen as catalogue data.

The tables hold no catalogue captures, so each view derives some from whole tables: observations
from line items, page logs from events, pages from the web pages, texts from the documents. A view
is one list of column expressions that both engines read; where their functions differ, ``{...}``
marks are filled per engine.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.operators.paging import new_rows_per_page, running_total
from anaquel.session import materialise
from anaquel.sources.dims import CONFIG

SPARK, DUCK = "spark", "duck"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give heavy per-row work a partition per core where the scan has fewer.

    A benchmark file holds one row group, which only one task can read. A table with more splits
    than cores stays as it is, so nothing is moved at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = spread(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def quote(value) -> str:
    return "null" if value is None else "'" + str(value).replace("'", "''") + "'"


def money_text(expr: str, engine: str) -> str:
    """An amount with thousands commas."""
    return f"format_number({expr}, 2)" if engine == SPARK else f"format('{{:,.2f}}', cast({expr} as double))"


def pick(expr: str, values: list, engine: str) -> str:
    """The value at a zero-based index."""
    listed = ", ".join(quote(v) for v in values)
    return f"element_at(array({listed}), cast({expr} as int) + 1)" if engine == SPARK else f"([{listed}])[{expr} + 1]"


def dim_rows(name: str) -> list[dict]:
    lines = (CONFIG / f"{name}.jsonl").read_text(encoding="utf-8").splitlines()
    return [json.loads(line) for line in lines if line.strip()]


def dim_cte(name: str) -> str:
    """A packaged dimension as SQL values."""
    rows = dim_rows(name)
    names = [c for c in rows[0] if c != "enabled"]
    values = ", ".join("(" + ", ".join(quote(r[c]) for c in names) + ")" for r in rows)
    return f"{name}({', '.join(names)}) as (values {values})"


RETAILER_ID = "case l_suppkey % 6 " + " ".join(
    f"when {i} then {quote(r.retailer_id)}" for i, r in enumerate(R.RETAILERS)
) + " end"
DISPLAY_NAME = "case l_suppkey % 6 " + " ".join(
    f"when {i} then {quote(r.display_name)}" for i, r in enumerate(R.RETAILERS)
) + " end"
LOCATION_ID = "case when l_tax > 0.07 then 'sin-ubicacion' else case l_suppkey % 6 " + " ".join(
    f"when {i} then {quote(r.location_id)}" for i, r in enumerate(R.RETAILERS)
) + " end end"


def _category_id() -> str:
    cases = []
    for i, r in enumerate(R.RETAILERS):
        ids = [c["category_id"] for c in dim_rows("dim_category") if c["retailer_id"] == r.retailer_id]
        cases += [f"when l_suppkey % 6 = {i} and l_partkey % 5 = {j} then {quote(c)}" for j, c in enumerate(ids)]
    return "case " + " ".join(cases) + " else 'sin-configurar' end"


CENTS = "cast(round(l_extendedprice * 100) as bigint)"
PERCENT = "cast(round(l_discount * 100) as bigint)"
NET = f"({CENTS} * (100 - {PERCENT}))"
REGULAR = f"cast(cast({CENTS} as decimal(14,0)) * 0.01 as decimal(12,2))"
CURRENT = f"cast(cast({NET} - {NET} % 100 as decimal(18,0)) * 0.0001 as decimal(12,2))"
SKU = "lpad(cast(l_partkey as string), 8, '0')"
STORE_ID = "case when l_linestatus = 'O' then null else cast(l_suppkey % 10 as string) end"

LISTING = {
    "scrape_timestamp": "cast(l_shipdate as timestamp)",
    "retailer": DISPLAY_NAME,
    "city": "nullif(l_returnflag, 'N')",
    "state": "'CDMX'",
    "postal_code": "cast(null as string)",
    "store": "case when l_linestatus = 'O' then null else 'Tienda ' || cast(l_suppkey % 10 as string) end",
    "store_id": STORE_ID,
    "department": "cast(null as string)",
    "category": "p_type",
    "subcategory": "cast(null as string)",
    "sub_subcategory": "cast(null as string)",
    "category_id": _category_id(),
    "sku": f"case when l_quantity = 50 then null when l_quantity = 48 then ' ' else {SKU} end",
    "brand": "p_brand",
    "product": "p_name",
    "price_current": f"case when l_quantity = 47 then null else {CURRENT} end",
    "price_regular": REGULAR,
    "promotion": "cast(null as string)",
    "pickup_available": "l_tax > 0.04",
    "store_context_verified": "case when l_discount = 0 then null else l_tax < 0.05 end",
    "store_context_method": "cast(null as string)",
    "url": f"case when l_quantity = 49 then null else '/' || replace(p_name, ' ', '-') || '-' || {SKU} || '/p' end",
    "price_raw": f"'$' || cast({CURRENT} as string)",
    "run_id": "l_orderkey",
    "page_number": "l_linenumber",
    "attempt": "1",
    "position": "l_suppkey",
    "retailer_id": RETAILER_ID,
    "location_id": LOCATION_ID,
}


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product observations."""
    return line_parts(spark, sf_dir).selectExpr(*[f"{e} as {n}" for n, e in LISTING.items()])


LISTING_CTE = (
    "listing as (select "
    + ", ".join(f"{e} as {n}" for n, e in LISTING.items())
    + " from lineitem join part on l_partkey = p_partkey)"
)

# A later batch brings the newest sightings without a store; everything else was there before.
INCOMING = "scrape_timestamp >= timestamp '2000-01-01' and store_id is null"


def batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = listing(spark, sf_dir)
    return rows.where(f"not ({INCOMING})"), rows.where(INCOMING)


BATCHES_CTE = (
    LISTING_CTE
    + f", existing as (select * from listing where not ({INCOMING})), incoming as (select * from listing where {INCOMING})"
)

# Card texts of every price and promotion rule, one card per line item.
BRAND_WORDS = sorted({b for r in R.RETAILERS for b in r.brands} | set(R.CHEDRAUI_PAGE_BRANDS))


def cards_columns(engine: str) -> dict[str, str]:
    now, usual = money_text(CURRENT, engine), money_text(REGULAR, engine)
    brand = pick(f"(l_partkey % {len(BRAND_WORDS)})", BRAND_WORDS, engine)
    named = (
        f"case l_linenumber when 1 then upper({brand}) || ' ' || p_name"
        f" when 2 then 'Porta' || lower({brand}) || ' ' || p_name"
        f" when 3 then p_name"
        f" when 4 then p_name || ' ' || {brand} || ' 90 ml'"
        f" when 5 then p_name || ' (' || lower({brand}) || ')'"
        f" when 6 then p_name || ' Colgate con ' || {brand}"
        f" else {brand} || 'x ' || p_name end"
    )
    return {
        "retailer_id": RETAILER_ID,
        "run_id": "l_orderkey",
        "page_number": "l_linenumber",
        "position": "l_suppkey",
        "part_id": "l_partkey",
        "product": named,
        "brand_word": brand,
        "now": CURRENT,
        "usual": REGULAR,
        "text_labelled": (
            "case l_linenumber"
            f" when 1 then p_name || ' precio actual MXN $' || {now} || ' Antes $' || {usual} || ' Pickup hoy'"
            f" when 2 then p_name || ' PRECIO  ACTUAL $ ' || {now} || ' costaba $' || {usual} || ' Rebaja'"
            f" when 3 then p_name || ' $' || {now} || ' $' || {usual} || ' Recoge en tienda Más vendido'"
            f" when 4 then p_name || ' $' || {now} || ' Antes $' || {usual} || ' Ahorra $10.00 rebaja'"
            f" when 5 then p_name || ' precio actual $' || {now} || ' Combina 2 x $' || {now}"
            f" when 6 then p_name || ' $' || {now} || ' recogida Precio en línea'"
            " else p_name || ' agotado' end"
        ),
        "text_lines": (
            "case l_linenumber"
            f" when 1 then upper({brand}) || '\n' || p_name || '\n$' || {usual} || '\n$' || {now} || '\nAgregar'"
            f" when 2 then p_name || '\n2 x 1\n$ ' || {usual} || '\n$' || {now}"
            f" when 3 then p_name || '\n3x$ 99.50 $' || {now}"
            f" when 4 then 'Oferta\n' || p_name || '\n$0.00\n$' || {now} || '\n$' || {usual}"
            f" when 5 then p_name || ' 25% de descuento $' || {usual} || ' MXN $' || {now}"
            f" when 6 then p_name || ' 5 %  descuento mxn $ ' || {now}"
            " else p_name || ' sin precio' end"
        ),
        "final_text": f"case when l_linenumber % 3 = 0 then null else 'MXN $' || {now} end",
        "old_text": f"case when l_linenumber % 2 = 0 then null else 'MXN $' || {usual} end",
        "offer_price": "case when l_linenumber = 7 then 'n/d' else cast(l_extendedprice as string) end",
        "badge": "case when l_linenumber % 2 = 0 then ' 3x2 ' else 'Nuevo' end",
        "badge_two": "case when l_linenumber % 3 = 0 then 'Nuevo' when l_linenumber % 3 = 1 then '' else 'Oferta' end",
    }


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_parts(spark, sf_dir).selectExpr(*[f"{e} as {n}" for n, e in cards_columns(SPARK).items()])


CARDS_CTE = (
    "cards as (select "
    + ", ".join(f"{e.replace(chr(10), chr(10))} as {n}" for n, e in cards_columns(DUCK).items())
    + " from lineitem join part on l_partkey = p_partkey)"
)

# Page logs: a listing per user and event type, a page per event in time order.
SLICE_KEY = ["slice"]
EVENT_ROWS = "cast(floor(value) as int) % 4"


def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: pages are numbered by time within each slice, minute by minute."""
    events = table(spark, sf_dir, "events").selectExpr(
        "'s' || cast(user_id as string) as slice", "ts", "event_id", "event_type", "value", "props",
        f"{EVENT_ROWS} as rows",
    )
    minute = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60)
    return running_total(events, SLICE_KEY, ["ts", "event_id"], F.lit(1), "page", minute).withColumn(
        "page", F.col("page").cast("int")
    )


PAGES_CTE = (
    "page_events as (select 's' || cast(user_id as string) as slice, ts, event_id, event_type, value, props, "
    f"{EVENT_ROWS} as rows, cast(row_number() over (partition by user_id order by ts, event_id) as int) as page from events)"
)


def rows_of_pages(events: DataFrame) -> DataFrame:
    """The product rows of each page."""
    return (
        events.where("rows > 0")
        .selectExpr("slice", "page", "event_id", "explode(sequence(1, rows)) as position")
        .selectExpr("slice", "page", "position", "'k' || cast((event_id * 7 + position * 3) % 60 as string) as sku")
    )


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of_pages(materialise(page_events(spark, sf_dir), "page-events"))


PAGE_ROWS_CTE = (
    "page_rows as (select slice, page, position, 'k' || cast((event_id * 7 + position * 3) % 60 as string) as sku "
    "from page_events, unnest(generate_series(1, rows)) as t(position) where rows > 0)"
)


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: rows and keys that are new in the slice; written once, as a run's log is."""
    events = materialise(page_events(spark, sf_dir), "page-events")
    visited = events.select("slice", "page", F.col("rows").cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("new"))
    new = new_rows_per_page(rows_of_pages(events), SLICE_KEY, F.col("sku"))
    log = (
        visited.unionByName(new.select("slice", "page", F.lit(0).cast("bigint").alias("rows"), "new"))
        .groupBy("slice", "page")
        .agg(F.sum("rows").alias("rows"), F.sum("new").alias("new"))
    )
    return materialise(log, "page-log")


PAGE_LOG_CTE = (
    PAGES_CTE
    + ", "
    + PAGE_ROWS_CTE
    + ", first_seen as (select slice, sku, min(page) as page from page_rows group by all)"
    + ", new_counts as (select slice, page, count(*) as n from first_seen group by all)"
    + ", page_log as (select p.slice, p.page, cast(p.rows as bigint) as rows, coalesce(n.n, 0) as new"
    + " from page_events p left join new_counts n on p.slice = n.slice and p.page = n.page)"
)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Displayed product total of each slice: what its events name, on average."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.expr("'s' || cast(user_id as string)").alias("slice"))
        .agg(F.expr("cast(30 + max(event_id) % 40 as bigint)").alias("displayed_total"))
    )


TOTALS_CTE = (
    "totals as (select 's' || cast(user_id as string) as slice, cast(30 + max(event_id) % 40 as bigint) as displayed_total "
    "from events group by 1)"
)

# Captures: the web pages as listing pages of the retailers.
PAGE_RETAILER = "case page_id % 6 " + " ".join(
    f"when {i} then {quote(r.retailer_id)}" for i, r in enumerate(R.RETAILERS)
) + " end"


def _number(k: int) -> str:
    return f"(1000 + page_id * 3 + {k})"


def _digits(k: int, plus: int = 0) -> str:
    return f"cast({_number(k)} + {plus} as string)"


def card_href(k: int) -> str:
    """Product link of a page's k-th card, in the form of the page's retailer."""
    n = _digits(k)
    forms = {
        "soriana": f"'/algo/' || {n} || '.html'",
        "chedraui": f"'/prod-' || {n} || '/p?x=1'",
        "farmacias-guadalajara": f"'/x-' || {_digits(k, 10000)} || '.html'",
        "farmacias-del-ahorro": f"'/y' || {n} || '.html'",
        "farmacias-san-pablo": f"'/z/p/000' || {n}",
        "walmart": f"'/ip/s/' || {_digits(k, 10000000)}",
    }
    return "case page_id % 6 " + " ".join(f"when {i} then {forms[r.retailer_id]}" for i, r in enumerate(R.RETAILERS)) + " end"


def _card_html(k: int) -> str:
    n, href = _digits(k), card_href(k)
    tile = (
        f"'<div class=\"product-tile js-product-card\" data-pid=\"P' || {n} || '\"><img class=\"tile-image\" alt=\"Foto\">"
        f"<a class=\"product-tile--link\" href=\"' || {href} || '\">Producto ' || {n} || '</a><span class=\"sales\">$' || {n} || "
        f"'.50</span><span class=\"list\">antes <span class=\"value\">$' || {_digits(k, 10)} || '.00</span></span>"
        "<span class=\"product-badge\">Nuevo</span></div>'"
    )
    card = (
        f"'<div class=\"card\"><a href=\"' || {href} || '\" aria-label=\"Producto ' || {n} || '\"><b>Producto ' || {n} || "
        f"'</b></a><p class=\"sellingPrice\">$' || {n} || '.50</p><p class=\"listPrice\">$' || {_digits(k, 10)} || "
        f"'.00</p><span class=\"promo-tag\">Oferta 2x1</span><button>Agregar ' || "
        f"case when page_id % 4 = {k} then 'envío' else 'pickup' end || '</button></div>'"
    )
    return f"case when page_id % 6 = 0 then {tile} else {card} end"


# Every page carries its own markup, three cards behind it, and the first card once more.
PAGE_HTML = "html || " + " || ".join(_card_html(k) for k in (1, 2, 3, 1))
CAPTURES = {"page_id": "page_id", "url": "url", "retailer_id": PAGE_RETAILER, "html": PAGE_HTML}


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).selectExpr(*[f"{e} as {n}" for n, e in CAPTURES.items()])


CAPTURES_CTE = "captures as (select " + ", ".join(f"{e} as {n}" for n, e in CAPTURES.items()) + " from pages)"

# Texts: documents as page bodies, some with a challenge or a store mentioned after them.
PHRASES = [
    "Access Denied", "Verify you are human. Press and hold.", "Captcha", "Verifica tu identidad",
    "Mantén presionado", "Request rejected", "You don't have permission to access this server", "GF R01",
    "Catálogo de productos", "Reference #18", "120 productos", "(1,284 Productos)", "35 producto 48 productos",
]


def texts_columns(engine: str) -> dict[str, str]:
    return {
        "doc_id": "doc_id",
        "retailer_id": "case doc_id % 6 "
        + " ".join(f"when {i} then {quote(r.retailer_id)}" for i, r in enumerate(R.RETAILERS))
        + " end",
        "status": "case doc_id % 17 when 3 then 403 when 5 then 401 when 7 then 429 when 9 then 503 when 11 then null else 200 end",
        "url": "case when doc_id % 23 = 4 then 'https://tienda.example/Blocked?x=1' else 'https://tienda.example/c/1' end",
        "title": pick(f"(doc_id % {len(PHRASES)})", PHRASES, engine),
        "body_text": f"text || '\n ' || {pick(f'((doc_id * 5) % {len(PHRASES)})', PHRASES, engine)}",
        "html": f"'<body>' || text || '  ' || {pick(f'((doc_id * 3) % {len(PHRASES)})', PHRASES, engine)} || '</body>'",
    }


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).selectExpr(*[f"{e} as {n}" for n, e in texts_columns(SPARK).items()])


TEXTS_CTE = "texts as (select " + ", ".join(f"{e} as {n}" for n, e in texts_columns(DUCK).items()) + " from documents)"

# Case log: one run per line of the grid and day, from events.
def case_log_columns(engine: str) -> dict[str, str]:
    rows = dim_rows("dim_category")
    n = len(rows) + 1
    ids = [r["retailer_id"] for r in rows] + ["otra-tienda"]
    cats = [r["category_id"] for r in rows] + ["otra-categoria"]
    phrases = [
        "Productos únicos: ", "BLOCKED: sesión ", "STORE_CONTEXT_ERROR: tienda ", "NETWORK_UNAVAILABLE: red ",
        "sin productos ", "Traceback ", "Productos únicos:",
    ]
    return {
        "event_id": "event_id",
        "ts": "ts",
        "retailer_id": pick(f"(event_id % {n})", ids, engine),
        "category_id": pick(f"(event_id % {n})", cats, engine),
        "exit_code": "cast(case when event_type = 'error' then 1 + event_id % 5 else 0 end as int)",
        "log_text": f"{pick(f'((event_id * 3) % {len(phrases)})', phrases, engine)} || cast(cast(floor(value) as int) as string)",
    }


def case_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {n}" for n, e in case_log_columns(SPARK).items()])


CASE_LOG_CTE = (
    "case_log as (select " + ", ".join(f"{e} as {n}" for n, e in case_log_columns(DUCK).items()) + " from events)"
)
