"""Extraction from pages and payloads."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.operators import dedup as D
from anaquel.operators import drift
from anaquel.operators import listing_html as H
from anaquel.operators import payloads as Q
from anaquel.operators.slices import union_retailers
from anaquel.plans.category_batch import category_batch
from anaquel.plans.extract import cards_of_all, observations_from_pages, observations_from_payloads
from anaquel.schema import CAPTURE
from anaquel.session import materialise, work_dir
from anaquel.sources.captures import conform
from anaquel.sources.consolidated import merge_batch, scan_summary
from anaquel.sources.dims import dim_category, dim_location
from workload import views as V
from workload.registry import SQL, edge, query

PAGE = ["page_id", "retailer_id"]


@query(
    "scan_captures",
    f"with {V.CAPTURES_CTE} select retailer_id, cast(page_id as bigint) as run_id, cast(null as integer) as status, url, html from captures",
)
def scan_captures(spark, sf):
    rows = V.captures(spark, sf).withColumnRenamed("page_id", "run_id")
    return conform(rows, CAPTURE).select("retailer_id", "run_id", "status", "url", "html")


HREF_SQL = r"""'(?is)^<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']'"""
ARIA_SQL = r"""'(?is)^<a\b[^>]*?\baria-label\s*=\s*["'']([^"'']*)["'']'"""
ANCHORS_CTE = (
    f"{V.CAPTURES_CTE}, lists as (select page_id, retailer_id, regexp_extract_all(html, '(?is)(<a\\b[^>]*>.*?</a>)', 1) as l from captures), "
    "anchors as (select page_id, retailer_id, i - 1 as position, l[i] as a from lists, unnest(generate_series(1, len(l))) as u(i))"
)


@query(
    "extract_anchors",
    f"with {ANCHORS_CTE} select page_id, retailer_id, cast(position as int) as position, nullif(regexp_extract(a, {HREF_SQL}, 1), '') as href, "
    r"nullif(trim(regexp_replace(replace(regexp_replace(a, '(?s)<[^>]*>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g')), '') as text, "
    f"nullif(regexp_extract(a, {ARIA_SQL}, 1), '') as aria_label from anchors",
)
def extract_anchors(spark, sf):
    return H.extract_anchors(V.captures(spark, sf), PAGE).drop("title")


LINK_SQL = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then regexp_matches(h, {V.quote(r.link_pattern)})" for r in R.RETAILERS
) + " end"


@query(
    "count_product_links",
    f"with {V.CAPTURES_CTE}, hrefs as (select distinct page_id, retailer_id, h from captures, "
    r"""unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)) as u(h)) """
    f"select page_id, retailer_id, cast(count(*) filter ({LINK_SQL}) as int) as product_links from hrefs group by all",
)
def count_product_links(spark, sf):
    return H.count_product_links(V.captures(spark, sf), PAGE)


# What the cards behind each page must give.
def expected_cards(retailers: list[str] | None = None) -> str:
    parts = []
    for k in (1, 2, 3):
        n, plus = V._digits(k), V._digits(k, 10)
        action = f"case when page_id % 4 = {k} then 'envío' else 'pickup' end"
        flat = f"'Producto ' || {n} || '$' || {n} || '.50$' || {plus} || '.00Oferta 2x1Agregar ' || {action}"
        lines = f"'Producto ' || {n} || chr(10) || '$' || {n} || '.50' || chr(10) || '$' || {plus} || '.00' || chr(10) || 'Oferta 2x1Agregar ' || {action}"
        tile = f"'Producto ' || {n} || '$' || {n} || '.50antes $' || {plus} || '.00Nuevo'"
        parts.append(
            f"select page_id, retailer_id, {k} as k, {V._number(k)} as n, {V.card_href(k)} as href, 'Producto ' || {n} as product, {action} as action, "
            f"case retailer_id when 'soriana' then {tile} when 'walmart' then {flat} when 'chedraui' then {flat} else {lines} end as text, "
            f"case when retailer_id = 'chedraui' then '$' || {n} || '.50' end as selling, "
            f"case when retailer_id = 'chedraui' then '$' || {plus} || '.00' end as regular, "
            f"case when retailer_id = 'soriana' then '$' || {n} || '.50 | $' || {plus} || '.00 | antes $' || {plus} || '.00' else '' end as price_texts, "
            "case retailer_id when 'soriana' then 'Nuevo' when 'chedraui' then 'Oferta 2x1' else '' end as promo_texts, "
            f"case when retailer_id = 'soriana' then 'P' || {n} end as data_pid from captures"
        )
    return (
        f"{V.CAPTURES_CTE}, cards as (select * from ({' union all '.join(parts)}) where retailer_id <> 'farmacias-del-ahorro')"
    )


def all_cards(spark, sf):
    pages = V.captures(spark, sf)
    return cards_of_all(pages, PAGE)


CARD_COLUMNS = ["page_id", "retailer_id", "href", "product", "text", "selling", "regular", "price_texts", "promo_texts", "data_pid"]


@query(
    "extract_cards",
    f"with {expected_cards()} select {', '.join(CARD_COLUMNS)} from cards union all select {', '.join(CARD_COLUMNS)} from cards "
    "where k = 1 and retailer_id not in ('walmart', 'chedraui')",
)
def extract_cards(spark, sf):
    return all_cards(spark, sf).select(
        "page_id", "retailer_id", "href", "product", "text", "selling", "regular",
        F.array_join("price_texts", " | ").alias("price_texts"), F.array_join("promo_texts", " | ").alias("promo_texts"),
        "data_pid",
    )


@query(
    "dedup_in_page",
    f"with {expected_cards()} select page_id, retailer_id, href, product from cards",
)
def dedup_in_page(spark, sf):
    cards = all_cards(spark, sf).withColumnRenamed("data_pid", "code")
    return D.dedup_in_page(cards, PAGE).select("page_id", "retailer_id", "href", "product")


@query(
    "top_pickup_links",
    f"with {expected_cards()}, p as (select page_id, href, k from cards where retailer_id = 'walmart' and action = 'pickup') "
    "select page_id, href, cast(row_number() over (partition by page_id order by k) as int) as rank from p",
)
def top_pickup_links(spark, sf):
    # The cards stand before the page's own markup, which may leave elements open around what follows it.
    cards = " || ".join(V._card_html(k) for k in (1, 2, 3, 1))
    pages = V.spread(V.table(spark, sf, "pages")).where(f"{V.PAGE_RETAILER} = 'walmart'").selectExpr("page_id", f"{cards} || html as html")
    return H.pickup_links(pages, ["page_id"], 5).select("page_id", "href", "rank")


# Wording outside the card: beside it or far above, in reach of eight nodes or not.
WORDED_HTML = (
    "'<section><p>' || case when page_id % 4 = 1 then 'Envío' else 'Recoge hoy' end || '</p>' || "
    "repeat('<div>', case page_id % 4 when 2 then 6 when 3 then 5 else 1 end) || '<div class=\"card\"><a href=\"/ip/s/' || page_id || "
    "'\">P</a><b>$10.00</b></div>' || repeat('</div>', case page_id % 4 when 2 then 6 when 3 then 5 else 1 end) || '</section>' || html"
)


@query(
    "pickup_links_climb",
    "select page_id, '/ip/s/' || page_id as href, cast(1 as int) as rank from pages where page_id % 4 in (0, 3)",
)
def pickup_links_climb(spark, sf):
    """All links, the wording standing outside the card with the price."""
    pages = V.spread(V.table(spark, sf, "pages")).selectExpr("page_id", f"{WORDED_HTML} as html")
    return H.pickup_links(pages, ["page_id"])


# Pages far larger than the tables hold: fifty cards each, by the rule that climbs most.
MANY = 50
MANY_HTML = (
    "'<main><div><section>' || array_join(transform(sequence(1, {n}), k -> '<div class=\"card\"><a href=\"/x-' || (100000 + page_id * 100 + k) || "
    "'.html\" title=\"Producto ' || k || '\"><i></i></a><p>Antes $' || (k + 20) || '.00</p><p>$' || (k + 10) || "
    "'.50</p><button>Agregar</button></div>'), '') || '</section></div></main>'"
).format(n=MANY)


@query(
    "extract_large_pages",
    f"select page_id, '/x-' || (100000 + page_id * 100 + k) || '.html' as href, 'Producto ' || k as product, "
    "'Antes $' || (k + 20) || '.00' || chr(10) || '$' || (k + 10) || '.50' || chr(10) || 'Agregar' as text "
    f"from pages, unnest(generate_series(1, {MANY})) as t(k)",
)
def extract_large_pages(spark, sf):
    pages = V.spread(V.table(spark, sf, "pages")).selectExpr("page_id", "'farmacias-guadalajara' as retailer_id", f"{MANY_HTML} as html")
    return H.extract_cards(pages, "farmacias-guadalajara", PAGE).select("page_id", "href", "product", "text")


# One page per product across each bound that a rule once had.
DEEP_HTML = (
    "'<div class=\"product-tile js-product-card\" data-pid=\"P' || page_id || '\"><div class=\"pdp-link\">' || repeat('<div>', 30) || "
    "'<a href=\"/d/' || page_id || '.html\">Producto</a>' || repeat('</div>', 30) || '</div><span class=\"sales\">$10.00</span></div>'"
)


@query("deep_tile_links", "select page_id, '/d/' || page_id || '.html' as href, 'Producto' as product from pages")
def deep_tile_links(spark, sf):
    pages = V.spread(V.table(spark, sf, "pages")).selectExpr("page_id", "'soriana' as retailer_id", f"{DEEP_HTML} as html")
    return H.extract_cards(pages, "soriana", PAGE).select("page_id", "href", "product")


# Two cards a page, each of over 3,000 characters and with its own price; the link stands twelve nodes deep in half of them.
LONG_CARD = (
    "'<div class=\"card\">' || repeat('<div>', {deep}) || '<a href=\"/' || page_id || '-' || k || '-{code}\" title=\"Producto ' || k || '\">Producto '"
    " || k || '</a>' || repeat('</div>', {deep}) || '<p>' || repeat('detalle largo ', 300) || '</p><b>$' || (15 + k) || '.50</b>{action}</div>'"
)


def long_card_pages(spark, sf, code, action):
    card = LONG_CARD.format(deep="case when page_id % 2 = 0 then 12 else 1 end", code=code, action=action)
    html = f"'<main><p>Oferta del día</p>' || array_join(transform(sequence(1, 2), k -> {card}), '') || '</main>'"
    return V.spread(V.table(spark, sf, "pages")).selectExpr("page_id", f"{html} as html")


LONG_FORMS = {
    "chedraui": ("0/p", ""), "farmacias-guadalajara": ("12345.html", "<button>Agregar</button>"), "walmart": ("0/ip/x", ""),
}


@query(
    "extract_long_cards",
    " union all ".join(
        f"select page_id, '{r}' as retailer_id, '/' || page_id || '-' || k || '-{code}' as href, true as own_price, false as other_price, true as long_card "
        "from pages, unnest(generate_series(1, 2)) as t(k)"
        for r, (code, _) in LONG_FORMS.items()
    ),
)
def extract_long_cards(spark, sf):
    """Each product gets the price of its own card, however long the card is and however deep its link."""
    parts = []
    for retailer_id, (code, action) in LONG_FORMS.items():
        pages = long_card_pages(spark, sf, code, action).withColumn("retailer_id", F.lit(retailer_id))
        rule = replace(H.CARD_RULES[retailer_id], levels=20)
        parts.append(H.extract_cards(pages, retailer_id, PAGE, rule).withColumn("retailer_id", F.lit(retailer_id)))
    k = F.regexp_extract("href", r"^/\d+-(\d)", 1).cast("int")
    holds = lambda number: F.contains("text", F.concat(F.lit("$"), (15 + number).cast("string"), F.lit(".50")))
    return union_retailers(parts).select(
        "page_id", "retailer_id", "href", holds(k).alias("own_price"), holds(3 - k).alias("other_price"), (F.length("text") > 3000).alias("long_card")
    )


@query(
    "twin_cards",
    "select page_id, repeat('igual ', 40) || k as text from pages, unnest(generate_series(1, 2)) as t(k)",
)
def twin_cards(spark, sf):
    """Two cards without link and code that agree in their first 240 characters are two."""
    pages = V.table(spark, sf, "pages").selectExpr("page_id", "explode(sequence(1, 2)) as k")
    cards = pages.selectExpr(
        "page_id", "k as position", "cast(null as string) as href", "cast(null as string) as code", "repeat('igual ', 40) || k as text"
    )
    return D.dedup_in_page(cards, ["page_id"]).select("page_id", "text")


OLD_HTML = (
    "'<html><h1>Producto</h1><h3 class=\"priceTotal\">$10.00</h3>' || array_join(transform(sequence(1, 15), "
    "k -> '<del>$' || (20 + k) || '.00</del>'), '') || '<i>' || page_id || '</i></html>'"
)


@query("many_old_prices", "select page_id, 10.0::double as price_current, 35.0::double as price_regular from pages")
def many_old_prices(spark, sf):
    """The largest of fifteen old prices, the last one, is the regular price."""
    pages = V.spread(V.table(spark, sf, "pages")).selectExpr("page_id", "url", f"{OLD_HTML} as html")
    return edge(H.product_details(pages, ["page_id", "url"]).select("page_id", "price_current", "price_regular"))


@query(
    "long_component_key",
    "select page_id, cast(page_id as varchar) as category_key from pages",
)
def long_component_key(spark, sf):
    """The key of a component that is longer than 12,000 characters, before another category's key."""
    component = "Infinite_EmpathySearch/js/view/search-list-component"
    html = f"'{{\"component\":\"{component}\",\"x\":\"' || repeat('z', 13000) || '\",\"categoryId\":\"' || page_id || '\"}} \"categoryId\":9'"
    pages = V.table(spark, sf, "pages").selectExpr("page_id", f"{html} as html")
    return pages.select("page_id", H.category_key(F.col("html")).alias("category_key"))


# Product pages of the retailer whose rows come from them: one per part.
PART_PAGES = {
    "page_id": "1000000 + p_partkey",
    "url": "'https://www.farmaciasanpablo.com.mx/x/p/00' || (700000 + p_partkey)",
    "retailer_id": "'farmacias-san-pablo'",
    "html": (
        "'<h1>' || p_name || ' Afrin</h1><h3 class=\"priceTotal\">$' || (10 + p_size) || '.50</h3>' || "
        "case when p_partkey % 3 = 0 then '' else '<del>$' || (20 + p_size) || '.00</del>' end"
    ),
}


def with_part_pages(spark, sf):
    parts = V.spread(V.table(spark, sf, "part")).selectExpr(*[f"{e} as {n}" for n, e in PART_PAGES.items()])
    return V.captures(spark, sf).unionByName(parts)


@query(
    "pages_to_observations",
    f"with {expected_cards()} select page_id, retailer_id, product, "
    "case retailer_id when 'soriana' then 'P' || n when 'walmart' then cast(n + 10000000 as string) when 'chedraui' then cast(n as string) "
    "else cast(n + 10000 as string) end as sku, cast(n + 0.5 as double) as price_current, cast(n + 10 as double) as price_regular, "
    "case retailer_id when 'soriana' then 'Nuevo' when 'chedraui' then 'Oferta 2x1' when 'walmart' then null else 'Precio promocional' end as promotion, "
    "case retailer_id when 'soriana' then 'https://www.soriana.com' when 'walmart' then 'https://www.walmart.com.mx' "
    "when 'chedraui' then 'https://www.chedraui.com.mx' else 'https://www.farmaciasguadalajara.com' end || href as url from cards "
    "where retailer_id <> 'farmacias-san-pablo' and (retailer_id <> 'walmart' or action = 'pickup') "
    "union all select 1000000 + p_partkey, 'farmacias-san-pablo', p_name || ' Afrin', cast(700000 + p_partkey as string), cast(10.5 + p_size as double), "
    "case when p_partkey % 3 = 0 then cast(10.5 + p_size as double) else cast(20 + p_size as double) end, "
    "case when p_partkey % 3 > 0 then cast(cast(round_even((1 - cast(10.5 + p_size as double) / cast(20 + p_size as double)) * 100, 0) as int) as string) || '% de descuento | Precio promocional' end, "
    "'https://www.farmaciasanpablo.com.mx/x/p/00' || (700000 + p_partkey) from part",
)
def pages_to_observations(spark, sf):
    out = observations_from_pages(with_part_pages(spark, sf), ["page_id"])
    return edge(out.select("page_id", "retailer_id", "product", "sku", "price_current", "price_regular", "promotion", "url"))


CATEGORY = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then {V.quote(next(c['category_id'] for c in V.dim_rows('dim_category') if c['retailer_id'] == r.retailer_id))}"
    for r in R.RETAILERS
) + " end"
PLACE = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then {V.quote(r.location_id)}" for r in R.RETAILERS
) + " end"


@query(
    "category_run",
    f"with {expected_cards()}, {V.dim_cte('dim_category')}, {V.dim_cte('dim_location')}, "
    f"kept as (select *, {CATEGORY} as category_id, {PLACE} as location_id from (select retailer_id from cards "
    "where retailer_id <> 'farmacias-san-pablo' and (retailer_id <> 'walmart' or action = 'pickup') union all select 'farmacias-san-pablo' from part)) "
    "select case k.retailer_id " + " ".join(f"when {V.quote(r.retailer_id)} then {V.quote(r.display_name)}" for r in R.RETAILERS) + " end as retailer, "
    "k.category_id, l.city, l.store, l.store_id, count(*) as products, count(*) as sku_complete, count(*) as price_complete, count(*) as url_complete "
    "from kept k join dim_category d on d.retailer_id = k.retailer_id and d.category_id = k.category_id "
    "join dim_location l on l.location_id = k.location_id group by all",
)
def category_run(spark, sf):
    """Pages to the consolidated table and its summary, all retailers and categories at once."""
    pages = with_part_pages(spark, sf).withColumns({"category_id": F.expr(CATEGORY), "location_id": F.expr(PLACE)})
    rows = materialise(observations_from_pages(pages, ["page_id", "category_id", "location_id"]), "observations")
    table = work_dir(spark, "category-run")
    batch, _ = category_batch(rows, dim_category(spark), dim_location(spark))
    merge_batch(spark, table, batch)
    return scan_summary(spark, table)


# Counters in page text and markup.
@query(
    "displayed_total",
    f"with {V.TEXTS_CTE} select doc_id, "
    r"list_max([try_cast(regexp_replace(x, '[,.]', '', 'g') as int) for x in "
    r"regexp_extract_all(body_text, '(?i)\(?\b(\d+(?:[,.]\d{3})*)\s+productos?\b\)?', 1)]) as largest, "
    r"try_cast(replace(nullif(regexp_extract(body_text, '(?i)\b([\d,]+)\s+Productos\b', 1), ''), ',', '') as int) as first_shown from texts",
)
def displayed_total(spark, sf):
    body = F.col("body_text")
    return V.texts(spark, sf).select(
        "doc_id", H.displayed_max(body).alias("largest"), H.displayed_first(body).alias("first_shown")
    )


COUNTER = (
    "html || case page_id % 5 when 0 then '<section class=\"c-pagination-carousel x\" data-total-pages=\"' || page_id % 7 || '\">' "
    "when 1 then '<section class=\"c-pagination-carousel\" data-total-pages=\"' || page_id || '.0\">' "
    "when 2 then '<section class=\"c-pagination-carousel\" data-total-pages=\"todo\">' else '<section class=\"otra\">' end"
)


@query(
    "total_pages",
    f"with {V.CAPTURES_CTE} select page_id, cast(case page_id % 5 when 0 then greatest(1, page_id % 7) when 1 then greatest(1, page_id) else 1 end as int) as total_pages from captures",
)
def total_pages(spark, sf):
    return V.captures(spark, sf).selectExpr("page_id", f"{COUNTER} as html").select(
        "page_id", H.total_pages(F.col("html")).alias("total_pages")
    )


CATEGORY_MARKUP = (
    "html || case page_id % 4 when 0 then '<script>{\"categoryId\":\"9\"}{\"component\":\"Infinite_EmpathySearch/js/view/search-list-component\",\n"
    " \"u\":\"x\", \"categoryId\" : \"' || (8000 + page_id) || '\"}{\"categoryId\":7}</script>' "
    "when 1 then '<script>{\"categoryId\":\"5\"}{\"categoryid\": ' || page_id || '}</script>' else '' end"
)


@query(
    "category_key",
    f"with {V.CAPTURES_CTE} select page_id, case page_id % 4 when 0 then cast(8000 + page_id as string) when 1 then cast(page_id as string) end as category_key from captures",
)
def category_key(spark, sf):
    return V.captures(spark, sf).selectExpr("page_id", f"{CATEGORY_MARKUP} as html").select(
        "page_id", H.category_key(F.col("html")).alias("category_key")
    )


# Detail pages: one per line item.
def details_columns() -> dict[str, str]:
    sku = "cast(7500000000000 + l_partkey as string)"
    price = f"cast({V.CURRENT} as string)"
    product = f"'{{\"@type\":\"Product\",\"name\":\" ' || p_name || ' \",\"brand\":\"' || p_brand || '\",\"gtin13\":\"' || {sku} || '\",\"offers\":{{\"price\":\"' || {price} || '\"}}}}'"
    branded = f"'{{\"@type\":\"product\",\"name\":\"' || p_name || '\",\"brand\":{{\"name\":\"' || p_brand || '\"}},\"sku\":' || l_partkey || ',\"offers\":[]}}'"
    script = "'<script type=\"application/ld+json\">' || {} || '</script>'"
    usual, now = f"cast({V.REGULAR} as string)", price
    return {
        "run_id": "l_orderkey", "page_number": "l_linenumber", "position": "l_suppkey", "part_id": "l_partkey",
        "url": "'https://www.farmaciasanpablo.com.mx/x/p/000' || l_partkey || '99'",
        "p_name": "p_name", "p_brand": "p_brand", "now": V.CURRENT, "usual": V.REGULAR, "gtin": sku,
        "html": "'<html><body>' || case l_linenumber when 1 then " + script.format(product)
        + " when 2 then " + script.format(f"'[{{\"@type\":\"Organization\",\"name\":\"x\"}},' || {product} || ']'")
        + " when 3 then " + script.format(f"'{{\"@graph\":[{{\"@type\":\"WebPage\"}},' || {product} || ']}}'")
        + " when 4 then " + script.format("'{\"@type\":\"Product\", rota'") + " || " + script.format(product)
        + " when 5 then " + script.format("'{\"@type\":\"Organization\",\"name\":\"x\"}'")
        + " when 6 then " + script.format(branded)
        + " else '<p>SKU: 123456789</p>' end || '<h1>' || p_name || ' Colgate</h1>' || "
        f"case when l_linenumber in (1, 4) then '' else '<h3 class=\"a priceTotal\">$' || {now} || '</h3><del>$' || {usual} || '</del>' end || "
        "'<span class=\"sku\">ref 654321</span></body></html>'",
    }


DETAILS_CTE = (
    "details as (select " + ", ".join(f"{e} as {n}" for n, e in details_columns().items())
    + " from lineitem join part on l_partkey = p_partkey)"
)
KEY = ["run_id", "page_number", "position", "part_id"]
KEYS = ", ".join(KEY)


def details(spark, sf):
    return V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in details_columns().items()])


@query(
    "extract_json_ld",
    f"with {DETAILS_CTE} select {KEYS}, p_name as product, p_brand as brand, "
    "case when page_number = 6 then cast(part_id as string) else gtin end as sku, "
    "case when page_number < 5 then cast(now as string) end as offer_price from details where page_number in (1, 2, 3, 4, 6)",
)
def extract_json_ld(spark, sf):
    return H.extract_json_ld(details(spark, sf), KEY)


# Structured data that nests: the product lies below as many lists and graphs as the line number says, after an entry of
# another type, and before a second product and a broken script.
def nested_columns() -> dict[str, str]:
    product = "'{\"@type\":\"Product\",\"name\":\"' || p_name || '\",\"brand\":{\"name\":\"' || p_brand || '\"},\"mpn\":' || l_suppkey || '}'"
    graph = "repeat('{\"@type\":\"WebPage\",\"@graph\":[{\"@type\":\"Thing\"},[', l_linenumber)"
    script = "'<script type=\"application/ld+json\">' || {} || '</script>'"
    later = script.format("'{\"@type\":\"Product\",\"name\":\"later\"}'")
    return {
        "run_id": "l_orderkey", "page_number": "l_linenumber", "position": "l_suppkey", "part_id": "l_partkey",
        "p_name": "p_name", "p_brand": "p_brand",
        "html": script.format("'{\"@graph\":[{\"@type\":\"Product\"'") + " || case when l_linenumber = 7 then '' else "
        + script.format(f"{graph} || {product} || repeat(']]}}', l_linenumber)") + f" end || {later}",
    }


NESTED_CTE = (
    "nested as (select " + ", ".join(f"{e} as {n}" for n, e in nested_columns().items())
    + " from lineitem join part on l_partkey = p_partkey)"
)


@query(
    "extract_nested_json_ld",
    f"with {NESTED_CTE} select {KEYS}, case when page_number = 7 then 'later' else p_name end as product, "
    "case when page_number < 7 then p_brand end as brand, "
    "case when page_number < 7 then cast(position as string) end as sku, cast(null as varchar) as offer_price from nested",
)
def extract_nested_json_ld(spark, sf):
    nested = V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in nested_columns().items()])
    return H.extract_json_ld(nested, KEY)


DETAIL_PCT = "cast(round_even((1 - cast(now as double) / cast(usual as double)) * 100, 0) as int)"


@query(
    "product_details",
    f"with {DETAILS_CTE} select {KEYS}, case when page_number < 5 then gtin when page_number = 6 and part_id >= 100000 then cast(part_id as string) else '654321' end as sku, "
    "case when page_number in (5, 7) then 'Colgate' else p_brand end as brand, "
    "case when page_number in (5, 7) then p_name || ' Colgate' else p_name end as product, cast(now as double) as price_current, "
    "cast(case when page_number in (1, 4) then now else usual end as double) as price_regular, "
    f"case when page_number not in (1, 4) and now < usual then cast({DETAIL_PCT} as string) || '% de descuento | Precio promocional' end as promotion from details",
)
def product_details(spark, sf):
    out = H.product_details(details(spark, sf), [*KEY, "url"])
    return edge(out.select(*KEY, "sku", "brand", "product", "price_current", "price_regular", "promotion"))


# Search payloads: two items per line item's page.
def search_columns() -> dict[str, str]:
    now, usual = f"cast({V.CURRENT} as string)", f"cast({V.REGULAR} as string)"
    first = (
        f"'{{\"sku\":\"' || {V.SKU} || '\",\"ecommTitle\":\" ' || p_name || '  Colgate\",\"ecommBrand\":' || case when l_linenumber = 3 then 'null' else '\"' || p_brand || '\"' end || "
        f"',\"ecommUrlKey\":\"' || replace(p_name, ' ', '-') || '\",\"currentPrice\":' || {now} || ',\"previousPrice\":' || case when l_linenumber = 2 then 'null' else {usual} end || '}}'"
    )
    second = (
        f"'{{\"sku\":\"' || case when l_linenumber = 4 then ' ' else 'S' || {V.SKU} end || '\",\"ecommTitle\":\"' || p_name || '\",\"ecommUrlKey\":\"k' || l_partkey || '\",\"currentPrice\":' || "
        f"case when l_linenumber = 5 then '\"n/d\"' else {usual} end || ',\"previousPrice\":' || {now} || '}}'"
    )
    return {
        "run_id": "l_orderkey", "page_number": "l_linenumber", "position_in_run": "l_suppkey", "part_id": "l_partkey",
        "p_name": "p_name", "p_brand": "p_brand", "now": V.CURRENT, "usual": V.REGULAR, "sku8": V.SKU,
        "payload": f"'{{\"catalog\":{{\"content\":[' || case when l_linenumber = 7 then '' else {first} || ',' || {second} end || '],\"pagination\":{{\"total\":' || l_orderkey || '}}}}}}'",
    }


SEARCH_CTE = (
    "search as (select " + ", ".join(f"{e} as {n}" for n, e in search_columns().items())
    + " from lineitem join part on l_partkey = p_partkey)"
)
SEARCH_KEY = ["run_id", "page_number", "position_in_run", "part_id"]


def search(spark, sf):
    return V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in search_columns().items()])


@query(
    "scan_search_payloads",
    f"with {SEARCH_CTE} select {', '.join(SEARCH_KEY)}, run_id as total, case when page_number = 7 then 0 else 2 end as n_items, "
    "cast(case when page_number = 7 then null else i end as int) as position, "
    "case when page_number = 7 then null when i = 0 then sku8 when page_number = 4 then ' ' else 'S' || sku8 end as sku "
    "from search, (values (0), (1)) as v(i) where page_number < 7 or i = 0",
)
def scan_search_payloads(spark, sf):
    items = Q.scan_search_payloads(search(spark, sf), SEARCH_KEY)
    return items.select(*SEARCH_KEY, "total", "n_items", "position", F.col("item.sku").alias("sku"))


@query(
    "map_search_items",
    f"with {SEARCH_CTE}, i as (select *, 0 as position, sku8 as sku, case when page_number = 3 then 'Colgate' else p_brand end as brand, p_name || ' Colgate' as product, "
    "now as c, case when page_number = 2 then now else usual end as r, replace(p_name, ' ', '-') as k from search where page_number < 7 "
    "union all select *, 1, 'S' || sku8, null, p_name, usual, usual, 'k' || part_id from search where page_number not in (4, 5, 7)) "
    f"select {', '.join(SEARCH_KEY)}, position, sku, brand, product, cast(c as double) as price_current, cast(r as double) as price_regular, "
    "case when c < r then case when cast(round_even((1 - cast(c as double) / cast(r as double)) * 100, 0) as int) > 0 "
    "then cast(cast(round_even((1 - cast(c as double) / cast(r as double)) * 100, 0) as int) as string) || '% de descuento | ' else '' end || 'Precio promocional' end as promotion, "
    "'https://www.fahorro.com/' || k || '.html' as url from i",
)
def map_search_items(spark, sf):
    rows = Q.map_search_items(Q.scan_search_payloads(search(spark, sf), SEARCH_KEY), SEARCH_KEY)
    return edge(rows.select(*SEARCH_KEY, "position", "sku", "brand", "product", "price_current", "price_regular", "promotion", "url"))


# Range payloads: one product with three offers per line item.
def ranges_columns() -> dict[str, str]:
    now, usual = f"cast({V.CURRENT} as string)", f"cast({V.REGULAR} as string)"

    def offer(default: str, price: str, listed: str, quantity: str, highlights: str, teasers: str) -> str:
        return (
            f"'{{\"sellerDefault\":{default},\"commertialOffer\":{{\"Price\":' || {price} || ',\"ListPrice\":' || {listed} || ',\"AvailableQuantity\":' || {quantity} || "
            f"',\"discountHighlights\":[' || {highlights} || '],\"teasers\":[' || {teasers} || ']}}}}'"
        )

    a = offer("false", f"case when l_linenumber in (6, 7) then '0' else {usual} end", usual, "'5'", "''", "''")
    b = offer(
        "true", f"case when l_linenumber = 7 then 'null' else {now} end", f"case when l_linenumber = 2 then '0' else {usual} end",
        "case when l_linenumber in (1, 6) then '0' when l_linenumber = 3 then 'null' else '3' end",
        "case when l_linenumber = 4 then '{\"name\":\"2x1\"},{\"name\":\"\"},{}' else '' end",
        "case when l_linenumber in (4, 5) then '{\"name\":\"Club\"},{\"name\":\"2x1\"}' else '' end",
    )
    c = offer("true", "case when l_linenumber = 5 then '9.99' else '0' end", "'19.99'", "'1'", "''", "'{\"name\":\"Otro\"}'")
    return {
        "run_id": "l_orderkey", "page_number": "l_linenumber", "position_in_run": "l_suppkey", "part_id": "l_partkey",
        "p_name": "p_name", "p_brand": "p_brand", "now": V.CURRENT, "usual": V.REGULAR,
        "payload": (
            "'{\"data\":{\"productSearch\":{\"recordsFiltered\":' || l_orderkey || ',\"products\":[{\"productId\":' || "
            "case when l_linenumber = 3 then '\"\",\"productReference\":\"R' || l_partkey || '\"' else '\"' || l_partkey || '\"' end || "
            "',\"productName\":\"' || p_name || ' Colgate\",\"brand\":' || case when l_linenumber = 2 then 'null' else '\"' || p_brand || '\"' end || "
            f"',\"link\":\"/x-' || l_partkey || '/p\",\"items\":[{{\"sellers\":[' || {a} || ',' || {b} || ']}},{{\"sellers\":[' || {c} || ']}}],"
            f"\"priceRange\":{{\"sellingPrice\":{{\"lowPrice\":' || {now} || '}},\"listPrice\":{{\"lowPrice\":' || {usual} || '}}}}}}]}}}}}}'"
        ),
    }


RANGES_CTE = (
    "ranges as (select " + ", ".join(f"{e} as {n}" for n, e in ranges_columns().items())
    + " from lineitem join part on l_partkey = p_partkey)"
)


def ranges(spark, sf):
    return V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in ranges_columns().items()])


# The offers un-nested: each line's three offers in document order, then the best one.
OFFERS_CTE = (
    f"{RANGES_CTE}, numbered as (select *, row_number() over () as rid from ranges), "
    "offers as (select rid, 0 as place, 1 as seller, case when page_number in (6, 7) then 0 else usual end as price, usual as listed, 5 as quantity, null as label from numbered "
    "union all select rid, 1, 0, case when page_number = 7 then null else now end, case when page_number = 2 then 0 else usual end, "
    "case when page_number in (1, 6) then 0 when page_number = 3 then null else 3 end, "
    "case page_number when 4 then '2x1 | Club' when 5 then 'Club | 2x1' end from numbered "
    "union all select rid, 2, 0, case when page_number = 5 then 9.99 else 0 end, 19.99, 1, 'Otro' from numbered), "
    "ranked as (select *, case when price > 0 and (quantity is null or quantity > 0) then 0 when price > 0 then 1 else 2 end as tier from offers), "
    "best as (select * from ranked where tier < 2 qualify row_number() over (partition by rid order by tier, seller, place) = 1), "
    "chosen as (select n.*, b.rid is not null as offered, b.quantity, b.label, coalesce(b.price, n.now) as p, "
    "case when b.rid is null then n.usual when b.listed > 0 then b.listed else b.price end as l from numbered n left join best b on n.rid = b.rid), "
    "priced as (select *, least(p, l) as c, greatest(p, l) as r from chosen)"
)


@query(
    "scan_product_search",
    f"with {RANGES_CTE} select {', '.join(SEARCH_KEY)}, run_id as records_filtered, p_name || ' Colgate' as product_name from ranges",
)
def scan_product_search(spark, sf):
    found = Q.scan_product_search(ranges(spark, sf), SEARCH_KEY)
    return found.select(*SEARCH_KEY, "records_filtered", F.col("found.productName").alias("product_name"))


@query(
    "best_offer",
    f"with {OFFERS_CTE} select {', '.join(SEARCH_KEY)}, offered, case when offered then quantity end as quantity, "
    "case when offered then cast(p as double) end as price from priced",
)
def best_offer(spark, sf):
    found = Q.scan_product_search(ranges(spark, sf), SEARCH_KEY)
    offer = Q.best_offer(F.col("found"))
    chosen = found.select(*SEARCH_KEY, offer.alias("offer"))
    return chosen.select(
        *SEARCH_KEY,
        F.col("offer").isNotNull().alias("offered"),
        F.col("offer.quantity").cast("int").alias("quantity"),
        F.col("offer.price").cast("double").alias("price"),
    )


@query(
    "map_product_search",
    f"with {OFFERS_CTE} select {', '.join(SEARCH_KEY)}, case when page_number = 3 then 'R' || part_id else cast(part_id as string) end as sku, "
    "case when page_number = 2 then 'Colgate' else p_brand end as brand, cast(c as double) as price_current, cast(r as double) as price_regular, "
    "coalesce(label, case when c < r then 'Precio promocional' end) as promotion, "
    "not offered or quantity is null or quantity > 0 as pickup_available, 'https://www.chedraui.com.mx/x-' || part_id || '/p' as url from priced",
)
def map_product_search(spark, sf):
    rows = Q.map_product_search(Q.scan_product_search(ranges(spark, sf), SEARCH_KEY), SEARCH_KEY)
    return edge(rows.select(*SEARCH_KEY, "sku", "brand", "price_current", "price_regular", "promotion", "pickup_available", "url"))


PAYLOAD_COLUMNS = "sku, brand, price_current, price_regular, promotion, url"


@query(
    "payloads_to_observations",
    f"select 'Farmacias del Ahorro' as retailer, {PAYLOAD_COLUMNS} from ({SQL['map_search_items']}) union all "
    f"select 'Chedraui', {PAYLOAD_COLUMNS} from ({SQL['map_product_search']})",
)
def payloads_to_observations(spark, sf):
    rows = observations_from_payloads(search(spark, sf), ranges(spark, sf), SEARCH_KEY)
    return edge(rows.select("retailer", *PAYLOAD_COLUMNS.split(", ")))


# Payloads that drift: a third of the runs as expected, a third with a renamed title and a nested price, a third with prices
# as text with a sign and a broken first page. Third lines have no sku.
def drifting_columns() -> dict[str, str]:
    price = f"cast({V.CURRENT} as string)"
    sku = "case when l_linenumber = 3 then '' else '\"sku\":' || l_suppkey || ',' end"
    plain = f"'\"ecommTitle\":\"' || p_name || '\",\"currentPrice\":' || {price}"
    renamed = f"'\"title\":\"' || p_name || '\",\"price\":{{\"now\":' || {price} || '}}'"
    signed = f"'\"ecommTitle\":\"' || p_name || '\",\"currentPrice\":\"$' || {price} || '\"'"
    way = "l_orderkey % 3"
    return {
        "run_id": "l_orderkey", "page_number": "l_linenumber", "position_in_run": "l_suppkey", "part_id": "l_partkey",
        "p_name": "p_name", "now": V.CURRENT, "way": way,
        "payload": f"case when {way} = 2 and l_linenumber = 1 then '{{\"catalog\":' else '{{\"catalog\":{{\"content\":[{{' || {sku} || "
        f"case {way} when 0 then {plain} when 1 then {renamed} else {signed} end || '}}],\"pagination\":{{\"total\":1}}}}}}' end",
    }


DRIFTING_CTE = (
    "drifting as (select " + ", ".join(f"{e} as {n}" for n, e in drifting_columns().items())
    + " from lineitem join part on l_partkey = p_partkey)"
)
ITEM = "catalog.content[]."
EXPECTED_PATHS = {
    f"{ITEM}sku": "number", f"{ITEM}ecommTitle": "text", f"{ITEM}currentPrice": "number", "catalog.pagination.total": "number",
}
DRIFTING_RULE = drift.PayloadRule(
    ("$.catalog.content",),
    {"sku": ("$.sku",), "product": ("$.ecommTitle", "$.title"), "price": ("$.currentPrice", "$.price.now")},
    {"price": "decimal(12,2)"},
    ("sku", "product", "price"),
)


def drifting(spark, sf):
    return V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in drifting_columns().items()])


@query(
    "payload_drift",
    f"with {DRIFTING_CTE}, readable as (select run_id, way, count(*) as n, count(*) filter (page_number <> 3) as skus from drifting "
    "where way < 2 or page_number > 1 group by all) "
    f"select run_id, '{ITEM}title' as path, 'text' as kind, 'unknown' as problem, n as pages from readable where way = 1 "
    f"union all select run_id, '{ITEM}price.now', 'number', 'unknown', n from readable where way = 1 "
    f"union all select run_id, '{ITEM}ecommTitle', null, 'missing', n from readable where way = 1 "
    f"union all select run_id, '{ITEM}currentPrice', null, 'missing', n from readable where way = 1 "
    f"union all select run_id, '{ITEM}sku', null, 'missing', n from readable where skus = 0 "
    f"union all select run_id, '{ITEM}currentPrice', 'text', 'kind', n from readable where way = 2 "
    "union all select run_id, null, null, 'broken', count(*) from drifting where way = 2 and page_number = 1 group by run_id",
)
def payload_drift(spark, sf):
    return drift.payload_drift(drifting(spark, sf), ["run_id"], EXPECTED_PATHS)


@query(
    "read_drifting_payloads",
    f"with {DRIFTING_CTE}, marked as (select *, way = 2 and page_number = 1 as broken from drifting) select {', '.join(SEARCH_KEY)}, "
    "case when not broken then 0 end as position, case when not broken and page_number <> 3 then cast(position_in_run as string) end as sku, "
    "case when not broken then p_name end as product, case when way < 2 then cast(now as double) end as price, "
    "case when broken then 'broken payload' when page_number = 3 then 'missing sku' when way = 2 then 'unfit price' end as reject_reason from marked",
)
def read_drifting_payloads(spark, sf):
    read = drift.read_payloads(drifting(spark, sf), SEARCH_KEY, DRIFTING_RULE)
    return edge(read.drop("raw"))
