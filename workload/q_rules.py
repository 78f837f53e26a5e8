"""Column jobs: text, money, prices, promotions, SKUs, addresses, brands, classification, evidence."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions import brands as B
from anaquel.functions import money as M
from anaquel.functions import text as X
from anaquel.functions import urls as U
from anaquel.operators import normalise as N
from anaquel.operators.brand_index import match_brands
from anaquel.operators.prices import extract_promotions, resolve_prices
from anaquel.operators.screening import classify_blocks, classify_outcomes, verify_stores
from anaquel.operators.shape import pickup_only, price_card_filter, product_link_filter
from anaquel.plans.usable_pages import usable_pages
from anaquel.sources.dims import dim_location
from workload import views as V
from workload.registry import edge, query

KEY = ["run_id", "page_number", "position", "part_id"]
KEYS = ", ".join(KEY)


# SQL forms of the token lists.
def dollar(text: str) -> str:
    return (
        f"list_filter([try_cast(replace(x, ',', '') as decimal(12,2)) for x in regexp_extract_all(coalesce({text}, ''), "
        r"'\$\s*([\d,]+(?:\.\d{1,2})?)', 1)], lambda v: v is not null)"
    )


def positive(text: str) -> str:
    return (
        f"list_filter([try_cast(replace(x, ',', '') as decimal(12,2)) for x in regexp_extract_all(coalesce({text}, ''), "
        r"'\$\s*([0-9][0-9,]*(?:\.\d{1,2})?)', 1)], lambda v: v > 0)"
    )


def mxn(text: str) -> str:
    return (
        f"list_filter([try_cast(replace(x, ',', '') as decimal(12,2)) for x in regexp_extract_all(coalesce({text}, ''), "
        r"'(?i)(?:MXN\s*)?\$\s*([0-9][0-9,]*(?:\.\d{1,2})?)', 1)], lambda v: v is not null)"
    )


def once(values: str) -> str:
    """A list without repeats, order kept."""
    return f"list_filter({values}, lambda v, i: list_position({values}, v) = i)"


def amount(text: str, pattern: str) -> str:
    return f"try_cast(replace(regexp_extract({text}, '{pattern}', 1), ',', '') as decimal(12,2))"


def joined(values: str) -> str:
    return f"nullif(array_to_string({values}, ' | '), '')"


def money_list(values: str) -> str:
    return f"array_to_string([cast(v as string) for v in {values}], ' ')"


def price_sql(current: str, regular: str, source: str = "cards", swap: str = "all", extra: str = "") -> str:
    order = {
        "all": "c > r",
        "nonzero": "c > r and c <> 0 and r <> 0",
        "never": "false",
    }[swap]
    return (
        f"with {V.CARDS_CTE}, found as (select *, {current} as c, {regular} as r from {source}), "
        f"priced as (select * exclude (c, r), case when {order} then r else c end as c, case when {order} then c else r end as r from found) "
        f"select {KEYS}, cast(c as double) as price_current, cast(r as double) as price_regular{extra} from priced"
    )


PRICES = [*KEY, "price_current", "price_regular"]


@query(
    "money_tokens",
    f"with {V.CARDS_CTE} select {KEYS}, {money_list(dollar('text_lines'))} as dollar, "
    f"{money_list(once(dollar('text_labelled')))} as distinct_dollar, {money_list(positive('text_lines'))} as positive, "
    f"{money_list(mxn('text_lines'))} as mxn from cards",
)
def money_tokens(spark, sf):
    def shown(values):
        return F.array_join(values.cast("array<string>"), " ")

    return V.cards(spark, sf).select(
        *KEY,
        shown(M.dollar_tokens(F.col("text_lines"))).alias("dollar"),
        shown(M.distinct_dollar_tokens(F.array("text_labelled"))).alias("distinct_dollar"),
        shown(M.positive_amounts(F.col("text_lines"))).alias("positive"),
        shown(M.mxn_amounts(F.col("text_lines"))).alias("mxn"),
    )


@query(
    "parse_money",
    f"with {V.CARDS_CTE} select {KEYS}, "
    r"cast(try_cast(regexp_extract(replace(final_text, ',', ''), '-?\d+(?:\.\d{1,2})?') as decimal(12,2)) as double) as parsed, "
    r"cast(try_cast(regexp_extract(replace(text_labelled, ',', ''), '-?\d+(?:\.\d{1,2})?') as decimal(12,2)) as double) as first_number "
    "from cards",
)
def parse_money(spark, sf):
    return edge(
        V.cards(spark, sf).select(
            *KEY,
            M.parse_money(F.col("final_text")).alias("parsed"),
            M.parse_money(F.col("text_labelled")).alias("first_number"),
        )
    )


@query(
    "to_price",
    f"with {V.CARDS_CTE} select {KEYS}, cast(try_cast(try_cast(offer_price as double) as decimal(12,2)) as double) as price "
    "from cards",
)
def to_price(spark, sf):
    return edge(V.cards(spark, sf).select(*KEY, M.to_price(F.col("offer_price")).alias("price")))


LISTED = once(f"list_concat({dollar('old_text')}, list_concat({dollar('final_text')}, {dollar('text_lines')}))")


@query("price_listed", price_sql(f"({LISTED})[1]", f"coalesce(({LISTED})[2], ({LISTED})[1])", swap="nonzero"))
def price_listed(spark, sf):
    rows = V.cards(spark, sf).withColumn("price_texts", F.array("old_text", "final_text", "text_lines"))
    return edge(resolve_prices(rows, "listed").select(*PRICES))


NOW_SQL = amount("text_labelled", r"(?i)precio\s+actual\s*(?:MXN)?\s*\$?\s*([\d,]+(?:\.\d{1,2})?)")
BEFORE_SQL = amount("text_labelled", r"(?i)(?:Antes|costaba)\s*\$?\s*([\d,]+(?:\.\d{1,2})?)")
TOKENS = dollar("text_labelled")


@query(
    "price_labelled",
    price_sql(
        f"coalesce({NOW_SQL}, ({TOKENS})[1])",
        f"case when {NOW_SQL} is null then coalesce(nullif({BEFORE_SQL}, 0), ({TOKENS})[2], ({TOKENS})[1]) "
        f"else coalesce({BEFORE_SQL}, {NOW_SQL}) end",
        swap="never",
    ),
)
def price_labelled(spark, sf):
    rows = V.cards(spark, sf).withColumnRenamed("text_labelled", "text")
    return edge(resolve_prices(rows, "labelled").select(*PRICES))


SELECTED = once(
    f"(case when page_number % 2 = 0 then {dollar('text_lines')} else {dollar('text_labelled')} end)"
)


def first_number(text: str) -> str:
    return f"try_cast(regexp_extract(replace({text}, ',', ''), '-?\\d+(?:\\.\\d{{1,2}})?') as decimal(12,2))"


@query(
    "price_selected",
    price_sql(
        f"coalesce({first_number('final_text')}, ({SELECTED})[1])",
        f"coalesce({first_number('old_text')}, ({SELECTED})[2], {first_number('final_text')}, ({SELECTED})[1])",
        swap="nonzero",
    ),
)
def price_selected(spark, sf):
    none = F.array().cast("array<string>")
    rows = V.cards(spark, sf).withColumns(
        {
            "selling": F.col("final_text"),
            "regular": F.col("old_text"),
            "price_texts": F.when(F.col("page_number") % 2 == 0, F.array("text_lines")).otherwise(none),
            "text": F.col("text_labelled"),
        }
    )
    return edge(resolve_prices(rows, "selected").select(*PRICES))


POSITIVE = positive("text_lines")


@query("price_first_last", price_sql(f"({POSITIVE})[-1]", f"({POSITIVE})[1]"))
def price_first_last(spark, sf):
    rows = V.cards(spark, sf).withColumnRenamed("text_lines", "text")
    return edge(resolve_prices(rows, "first_last").select(*PRICES))


MXN = mxn("text_lines")


@query(
    "price_card",
    price_sql(
        f"coalesce(({mxn('final_text')})[1], ({MXN})[-1])",
        f"coalesce(({mxn('old_text')})[1], list_max({MXN}), ({mxn('final_text')})[1], ({MXN})[-1])",
    ),
)
def price_card(spark, sf):
    rows = V.cards(spark, sf).withColumnRenamed("text_lines", "text")
    return edge(resolve_prices(rows, "card").select(*PRICES))


@query("price_min_max", price_sql(f"list_min({POSITIVE})", f"list_max({POSITIVE})", swap="never"))
def price_min_max(spark, sf):
    rows = V.cards(spark, sf).withColumnRenamed("text_lines", "text")
    return edge(resolve_prices(rows, "min_max").select(*PRICES))


MAIN = positive("final_text")
OFFER = "try_cast(try_cast(offer_price as double) as decimal(12,2))"


@query(
    "price_detail",
    price_sql(
        f"coalesce(({MAIN})[1], {OFFER})",
        f"case when ({MAIN})[1] is not null then list_max(list_concat({MAIN}, list_concat({positive('old_text')}, {POSITIVE}))) else {OFFER} end",
        swap="never",
    ),
)
def price_detail(spark, sf):
    rows = V.cards(spark, sf).withColumns(
        {"price_text": F.col("final_text"), "old_texts": F.array("old_text", "text_lines", "badge")}
    )
    return edge(resolve_prices(rows, "detail").select(*PRICES))


@query(
    "price_previous",
    price_sql("now", "case when page_number % 2 = 0 or usual < now then now else usual end", swap="never"),
)
def price_previous(spark, sf):
    rows = V.cards(spark, sf).selectExpr(
        *KEY, "cast(now as string) as current_price",
        "case when page_number % 2 = 0 then null else cast(usual as string) end as previous_price",
    )
    return edge(resolve_prices(rows, "previous").select(*PRICES))


@query(
    "price_raw",
    f"with {V.CARDS_CTE} select {KEYS}, "
    "'{\"currentPrice\":' || cast(cast(now as double) as string) || ',\"previousPrice\":' || "
    "case when page_number % 2 = 0 then 'null' else cast(cast(usual as double) as string) end || '}' as as_json, "
    "trim(regexp_replace(text_lines, '\\s+', ' ', 'g')) as as_text, "
    "array_to_string([t for t in [old_text, final_text] if t is not null], ' | ') as as_list from cards",
)
def price_raw(spark, sf):
    rows = V.cards(spark, sf)
    previous = F.when(F.col("page_number") % 2 != 0, F.col("usual").cast("double"))
    return rows.select(
        *KEY,
        M.evidence_json(currentPrice=F.col("now").cast("double"), previousPrice=previous).alias("as_json"),
        X.clean_text(F.col("text_lines")).alias("as_text"),
        F.concat_ws(" | ", "old_text", "final_text").alias("as_list"),
    )


# Promotions.
def labels(*values: str) -> str:
    listed = f"[x for x in [{', '.join(values)}] if x is not null and x <> '']"
    return joined(once(listed))


LOWERED = "case when price_current < price_regular then 'Precio promocional' end"
PRICED = "(select *, now as price_current, usual as price_regular from cards)"


def promo_sql(label: str) -> str:
    return f"with {V.CARDS_CTE} select {KEYS}, {label} as promotion from {PRICED}"


def promo(spark, sf, rule, text=None):
    rows = V.cards(spark, sf).withColumns({"price_current": F.col("now"), "price_regular": F.col("usual")})
    if text:
        rows = rows.withColumn("text", F.col(text))
    return extract_promotions(rows, rule).select(*KEY, "promotion")


@query("promo_badges", promo_sql(labels("trim(badge)", "trim(badge_two)", "trim(badge)")))
def promo_badges(spark, sf):
    rows = V.cards(spark, sf).withColumn("promo_texts", F.array("badge", "badge_two", "badge"))
    return extract_promotions(rows, "badges").select(*KEY, "promotion")


@query(
    "promo_shelf_labels",
    promo_sql(
        labels(
            *[
                f"regexp_extract(text_labelled, '(?i){p}')"
                for p in ("Rebaja", "Precio en línea", "Más vendido", r"Combina\s+\d+\s*x\s*\$[\d,.]+", r"Ahorra\s*\$[\d,.]+")
            ]
        )
    ),
)
def promo_shelf_labels(spark, sf):
    return promo(spark, sf, "shelf_labels", "text_labelled")


@query(
    "promo_multibuy",
    promo_sql(
        labels(
            r"regexp_extract(text_lines, '(?i)\b\d+\s*x\s*\d+\b')",
            r"regexp_extract(text_lines, '(?i)\b\d+\s*x\s*\$\s*\d+(?:\.\d+)?')",
            LOWERED,
        )
    ),
)
def promo_multibuy(spark, sf):
    return promo(spark, sf, "multibuy", "text_lines")


@query(
    "promo_percent_text",
    promo_sql(
        labels(
            r"nullif(regexp_extract(text_lines, '(?i)\b(\d{1,2})\s*%\s*(?:de\s*)?descuento\b', 1), '') || '% de descuento'",
            LOWERED,
        )
    ),
)
def promo_percent_text(spark, sf):
    return promo(spark, sf, "percent_text", "text_lines")


PCT = "cast(round_even((1 - cast(price_current as double) / cast(price_regular as double)) * 100, 0) as int)"
PCT_TEXT = f"cast({PCT} as string) || '% de descuento | Precio promocional'"


@query(
    "promo_computed",
    promo_sql(
        f"case when price_current < price_regular then case when {PCT} > 0 then {PCT_TEXT} else 'Precio promocional' end end"
    ),
)
def promo_computed(spark, sf):
    return promo(spark, sf, "computed")


@query(
    "promo_computed_keep_zero",
    f"with {V.CARDS_CTE} select {KEYS}, case when price_current < price_regular then {PCT_TEXT} end as promotion "
    "from (select *, usual - 0.01 * part_id as price_current, usual as price_regular from cards)",
)
def promo_computed_keep_zero(spark, sf):
    rows = V.cards(spark, sf).withColumns(
        {"price_current": F.expr("usual - 0.01 * part_id"), "price_regular": F.col("usual")}
    )
    return extract_promotions(rows, "computed_keep_zero").select(*KEY, "promotion")


# Text.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def spaced(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}', ' ', 'g'))"


def folded(text: str) -> str:
    return spaced(f"translate(lower({text}), 'áéíóúü', 'aeiouu')")


@query(
    "clean_text",
    f"select doc_id, nullif({spaced('text')}, '') as cleaned from documents",
)
def clean_text(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query("fold_accents", f"select doc_id, {folded('text')} as folded from documents")
def fold_accents(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.fold_accents(F.col("text")).alias("folded"))


# Texts as they stand in a query string: per cents of the text itself are encoded too, some sequences are broken.
ENCODED = "replace(replace(text, '%', '%25'), ' ', '%20') || '+Caf%C3%A9+%C3%81+50%25+%zz+100%'"


@query(
    "fold_decoded",
    "select conv_id, turn, "
    + folded("text || '+Café+Á+50%+%zz+100%'")
    + " as folded from conversations",
)
def fold_decoded(spark, sf):
    rows = V.table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", X.fold_decoded(F.expr(ENCODED)).alias("folded"))


@query(
    "fallback_title",
    f"with {V.CARDS_CTE}, t as (select *, case when page_number % 3 = 0 then '  ' when page_number % 3 = 1 then null else product end as t, "
    f"{spaced('text_lines')} as line from cards) "
    f"select {KEYS}, coalesce(nullif({spaced('t')}, ''), case when not contains(line, '$') and length(line) > 5 then line end) as title from t",
)
def fallback_title(spark, sf):
    title = F.expr("case when page_number % 3 = 0 then '  ' when page_number % 3 = 1 then null else product end")
    return V.cards(spark, sf).select(*KEY, X.fallback_title(title, F.col("text_lines")).alias("title"))


@query(
    "normalise_listings",
    f"with {V.CARDS_CTE} select {KEYS}, case retailer_id "
    + " ".join(f"when {V.quote(r.retailer_id)} then {V.quote(r.display_name)}" for r in R.RETAILERS)
    + f" end as retailer, nullif({spaced('product')}, '') as product, {spaced('text_lines')} as text, "
    "strftime(timestamp '2026-08-18 18:00:00' + to_hours(cast(page_number as int)), '%Y-%m-%d %H:%M:%S') as scrape_timestamp from cards",
)
def normalise_listings(spark, sf):
    rows = V.cards(spark, sf).withColumns(
        {
            "text": F.col("text_lines"),
            "scrape_timestamp_raw": F.expr("format_string('2026-08-18T%02d:00:00-06:00', 12 + page_number)"),
        }
    )
    in_utc = F.to_utc_timestamp("scrape_timestamp", F.current_timezone()).alias("scrape_timestamp")
    return edge(N.normalise_listings(rows).select(*KEY, "retailer", "product", "text", in_utc))


# SKUs and addresses.
URL_FORMS = {
    "url": (
        "case l_linenumber when 1 then 'https://tienda.example/algo/' || {n} || '.html'"
        " when 2 then 'https://tienda.example/Pasta-Total-12-' || {n} || '/P?skuId=1'"
        " when 3 then 'https://tienda.example/ip/pasta/0000' || {n8} || '?a=/1.html'"
        " when 4 then 'https://tienda.example/x--10-pzas.-' || {n5} || '.html#top'"
        " when 5 then '/medicamentos/p/000' || {n} || '/x'"
        " when 6 then '/p/000000?x' else 'https://tienda.example/' end"
    ),
    "data_pid": "case when l_quantity > 45 then ' AB' || {n} || ' ' when l_quantity > 40 then '' when l_quantity > 38 then '  ' end",
}


def url_columns() -> dict[str, str]:
    parts = {
        "n": "cast(l_partkey as string)",
        "n8": "lpad(cast(l_partkey as string), 8, '0')",
        "n5": "cast(10000 + l_partkey as string)",
    }
    return {
        "retailer_id": V.RETAILER_ID, "run_id": "l_orderkey", "page_number": "l_linenumber", "position": "l_suppkey",
        "part_id": "l_partkey", **{k: e.format(**parts) for k, e in URL_FORMS.items()},
        "html": (
            "case l_linenumber % 6 when 0 then '<meta itemprop=\"sku\" content=\" A' || {n} || '\">'"
            " when 1 then '<meta name=\"a\" content=''B' || {n} || ''' itemprop=\"sku\">'"
            " when 2 then '<div class=\"value\" itemprop=\"sku\"> C' || {n} || '</div>'"
            " when 3 then '{{\"x\": 1, \"sku\" : \"D' || {n} || '\"}}'"
            " when 4 then '<th>SKU</th> <td>E' || {n} || ' </td>' else '<p>sin clave</p>' end"
        ).format(**parts),
    }


URLS_CTE = "urls as (select " + ", ".join(f"{e} as {n}" for n, e in url_columns().items()) + " from lineitem)"


def url_rows(spark, sf):
    return V.spread(V.table(spark, sf, "lineitem")).selectExpr(*[f"{e} as {n}" for n, e in url_columns().items()])


PATH_SQL = r"regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"
PATH_SKU = (
    r"coalesce(nullif(regexp_extract({p}, '/(\d+)\.html/?$', 1), ''), nullif(regexp_extract({p}, '(?i)-(\d{{4,20}})/p/?$', 1), ''), "
    r"nullif(regexp_extract({p}, '/(\d{{8,20}})/?$', 1), ''))"
).format(p=PATH_SQL)
PID_SKU = f"case when coalesce(data_pid, '') <> '' then nullif(trim(data_pid), '') else {PATH_SKU} end"
DASH_SKU = r"nullif(regexp_extract(url, '(?i)-(\d{5,14})\.html(?:$|[?#])', 1), '')"
P_RAW = r"nullif(regexp_extract(url, '(?i)/p/(\d+)(?:$|[/?#])', 1), '')"
P_SKU = f"coalesce(nullif(ltrim({P_RAW}, '0'), ''), {P_RAW})"


@query(
    "sku_from_url",
    f"with {URLS_CTE} select {KEYS}, {PATH_SKU} as from_url, {PID_SKU} as with_pid, "
    f"coalesce(nullif(trim(data_pid), ''), {DASH_SKU}) as dashed, {P_SKU} as from_p from urls",
)
def sku_from_url(spark, sf):
    url, pid = F.col("url"), F.col("data_pid")
    return url_rows(spark, sf).select(
        *KEY,
        U.sku_from_url(url).alias("from_url"),
        U.sku_from_url(url, pid).alias("with_pid"),
        U.sku_dash_html(url, pid).alias("dashed"),
        U.sku_p_path(url).alias("from_p"),
    )


@query(
    "sku_from_html",
    f"with {URLS_CTE} select {KEYS}, "
    r"""coalesce(nullif(trim(regexp_extract(html, '(?i)itemprop=["'']sku["''][^>]*content=["'']([^"'']+)', 1)), ''),
    nullif(trim(regexp_extract(html, '(?i)<meta[^>]+content=["'']([^"'']+)["''][^>]+itemprop=["'']sku["'']', 1)), ''),
    nullif(trim(regexp_extract(html, '(?i)itemprop=["'']sku["''][^>]*>\s*([^<]+)', 1)), ''),
    nullif(trim(regexp_extract(html, '(?i)"sku"\s*:\s*"([^"]+)"', 1)), ''),
    nullif(trim(regexp_extract(html, '(?i)\bSKU\b\s*</[^>]+>\s*<[^>]+>\s*([^<]+)', 1)), '')) as sku from urls""",
)
def sku_from_html(spark, sf):
    return url_rows(spark, sf).select(*KEY, U.sku_html(F.col("html")).alias("sku"))


@query(
    "assign_sku",
    f"with {URLS_CTE} select {KEYS}, case when retailer_id = 'farmacias-guadalajara' then coalesce(nullif(trim(data_pid), ''), {DASH_SKU}) "
    f"when retailer_id = 'farmacias-san-pablo' then coalesce(nullif(trim(data_pid), ''), {P_SKU}) "
    f"when retailer_id in ('walmart', 'chedraui') then {PATH_SKU} else {PID_SKU} end as sku from urls",
)
def assign_sku(spark, sf):
    return N.assign_sku(url_rows(spark, sf)).select(*KEY, "sku")


HREF = (
    "case page_number when 1 then 'https://otra.example/a' when 2 then '//cdn.example/a' when 3 then '/p/' || part_id "
    "when 4 then '../x/' || part_id when 5 then 'x/' || part_id || '.html' when 6 then '' else 'mailto:a@b.example' end"
)
BASE_SQL = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then {V.quote(r.base_url.rstrip('/'))}" for r in R.RETAILERS
) + " end"


@query(
    "canonicalise_urls",
    f"with {URLS_CTE}, h as (select *, {HREF} as href, {BASE_SQL} as root from urls) select {KEYS}, "
    "case when page_number in (1, 7) then href when page_number = 2 then 'https:' || href when page_number = 3 then root || href "
    "when page_number = 4 then root || '/x/' || part_id when page_number = 5 then root || '/' || href end as url from h",
)
def canonicalise_urls(spark, sf):
    rows = url_rows(spark, sf).withColumn("href", F.expr(HREF))
    return N.canonicalise_urls(rows).select(*KEY, "url")


PARAM_SQL = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then {V.quote(r.page_parameter)}" for r in R.RETAILERS
) + " end"


@query(
    "page_urls",
    f"with {V.CAPTURES_CTE}, p as (select page_id, url, n, {PARAM_SQL} as k, regexp_extract(url, '^[^?#]*') as prefix, "
    r"list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '') as q, "
    "regexp_extract(url, '#.*$') as frag from captures, generate_series(1, 3) as s(n)), "
    "r as (select *, case when n <= 1 then list_filter(q, lambda x: split_part(x, '=', 1) <> k) "
    "when len(list_filter(q, lambda x: split_part(x, '=', 1) = k)) > 0 "
    "then list_transform(q, lambda x: case when split_part(x, '=', 1) = k then k || '=' || n else x end) "
    "else list_append(q, k || '=' || n) end as changed from p) "
    "select page_id, cast(n as int) as page, case when n <= 1 and k <> 'page' then url "
    "else prefix || case when len(changed) > 0 then '?' || array_to_string(changed, '&') else '' end || frag end as page_url from r",
)
def page_urls(spark, sf):
    pages = V.captures(spark, sf).select("page_id", "url", "retailer_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page"))
    return pages.select(
        "page_id", "page", N.listing_page_url(F.col("retailer_id"), F.col("url"), F.col("page")).alias("page_url")
    )


# Brands.
def brand_values(brands) -> str:
    return ", ".join(f"({i}, {V.quote(b)})" for i, b in enumerate(brands))


def word_case(text: str, brands, named=lambda b: b) -> str:
    """First whole-word brand in list order; RE2 has no look-around, so the neighbours are spelled out."""
    tests = []
    for b in brands:
        word = re.sub(r"([.&-])", r"\\\1", b.lower())
        pattern = rf"(^|[^\pL\pN_]){word}($|[^\pL\pN_])"
        tests.append(f"when regexp_matches(lower({text}), {V.quote(pattern)}) then {V.quote(named(b))}")
    return "case " + " ".join(tests) + " end"


def substring_sql(brands) -> str:
    return (
        f"with {V.CARDS_CTE}, brands(pos, brand) as (values {brand_values(brands)}), "
        "products as (select distinct product as t from cards), "
        "hits as (select t, arg_min(b.brand, b.pos) as brand from products join brands b on contains(lower(t), lower(b.brand)) group by t) "
        f"select {KEYS}, c.product, h.brand as inferred from cards c left join hits h on h.t = product"
    )


def boundary_sql(text: str, brands, named=lambda b: b) -> str:
    return f"with {V.CARDS_CTE} select {KEYS}, product, {word_case(text, brands, named)} as inferred from cards"


def brand_frame(spark, sf, column):
    return V.cards(spark, sf).select(*KEY, "product", column.alias("inferred"))


SORIANA, WALMART, CHEDRAUI = R.BY_ID["soriana"], R.BY_ID["walmart"], R.BY_ID["chedraui"]
GUADALAJARA, AHORRO, SAN_PABLO = (
    R.BY_ID["farmacias-guadalajara"], R.BY_ID["farmacias-del-ahorro"], R.BY_ID["farmacias-san-pablo"],
)


@query("brand_substring_soriana", substring_sql(SORIANA.brands))
def brand_substring_soriana(spark, sf):
    return brand_frame(spark, sf, B.brand_substring(F.col("product"), SORIANA.brands))


@query("brand_substring_walmart", substring_sql(WALMART.brands))
def brand_substring_walmart(spark, sf):
    return brand_frame(spark, sf, B.brand_substring(F.col("product"), WALMART.brands))


@query("brand_substring_chedraui", substring_sql(R.CHEDRAUI_PAGE_BRANDS))
def brand_substring_chedraui(spark, sf):
    return brand_frame(spark, sf, B.brand_substring(F.col("product"), R.CHEDRAUI_PAGE_BRANDS))


@query("brand_boundary_guadalajara", boundary_sql("text_lines", GUADALAJARA.brands))
def brand_boundary_guadalajara(spark, sf):
    return brand_frame(spark, sf, B.brand_boundary(X.clean_text(F.col("text_lines")), GUADALAJARA.brands))


@query("brand_boundary_ahorro", boundary_sql("product", AHORRO.brands))
def brand_boundary_ahorro(spark, sf):
    return brand_frame(spark, sf, B.infer_brand(AHORRO, F.col("product")))


@query(
    "brand_boundary_san_pablo",
    boundary_sql("product", SAN_PABLO.brands, lambda b: "Stérimar" if b == "Sterimar" else b),
)
def brand_boundary_san_pablo(spark, sf):
    return brand_frame(spark, sf, B.infer_brand(SAN_PABLO, F.col("product")))


@query(
    "brand_longest",
    boundary_sql("product", sorted(CHEDRAUI.brands, key=len, reverse=True)),
)
def brand_longest(spark, sf):
    return brand_frame(spark, sf, B.brand_longest(F.col("product"), CHEDRAUI.brands))


@query(
    "brand_headline",
    f"with {V.CARDS_CTE} select {KEYS}, p_name as name, case when page_number = 1 and length(upper(brand_word)) <= 40 then "
    r"case when length(brand_word) > 4 then array_to_string([upper(x[1:1]) || lower(x[2:]) for x in regexp_extract_all(upper(brand_word), '(\pL+|[^\pL]+)', 1)], '') "
    "else upper(brand_word) end end as inferred from cards join part on p_partkey = part_id",
)
def brand_headline(spark, sf):
    names = V.table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("name"))
    rows = V.cards(spark, sf).join(names, "part_id")
    return rows.select(*KEY, "name", B.brand_headline(F.col("name"), F.col("text_lines")).alias("inferred"))


@query(
    "brand_cascade",
    f"with {V.CARDS_CTE}, "
    "own as (select *, case when page_number % 3 = 0 then brand_word when page_number % 3 = 1 then '  ' end as own from cards) "
    f"select {KEYS}, coalesce(nullif(trim(own), ''), {word_case('product', AHORRO.brands)}) as brand from own",
)
def brand_cascade(spark, sf):
    rows = V.cards(spark, sf).withColumns(
        {
            "retailer_id": F.lit("farmacias-del-ahorro"),
            "text": F.lit(None).cast("string"),
            "brand": F.expr("case when page_number % 3 = 0 then brand_word when page_number % 3 = 1 then '  ' end"),
        }
    )
    return N.infer_brands(rows).select(*KEY, "brand")


# Filters on cards.
@query(
    "pickup_only",
    f"with {V.CARDS_CTE} select {KEYS}, text_labelled as text from cards "
    r"where regexp_matches(text_labelled, '(?i)\b(pickup|recoge|recoger|recogida)\b')",
)
def pickup_only_query(spark, sf):
    return pickup_only(V.cards(spark, sf).withColumnRenamed("text_labelled", "text")).select(*KEY, "text")


@query(
    "price_card_filter",
    f"with {V.CARDS_CTE} select {KEYS}, text_labelled as text from cards where "
    r"regexp_matches(text_labelled, '\$\s*[\d,.]+') and case retailer_id when 'walmart' then length(text_labelled) > 20 "
    "when 'chedraui' then length(text_labelled) > 20 and length(text_labelled) < 3000 "
    "when 'farmacias-guadalajara' then length(text_labelled) between 15 and 3000 else true end",
)
def price_card_filter_query(spark, sf):
    return price_card_filter(V.cards(spark, sf).withColumnRenamed("text_labelled", "text")).select(*KEY, "text")


LINK_SQL = "case retailer_id " + " ".join(
    f"when {V.quote(r.retailer_id)} then regexp_matches(url, {V.quote(r.link_pattern)})" for r in R.RETAILERS
) + " end"


@query("product_link_filter", f"with {URLS_CTE} select {KEYS}, retailer_id, url from urls where {LINK_SQL}")
def product_link_filter_query(spark, sf):
    return product_link_filter(url_rows(spark, sf), "url").select(*KEY, "retailer_id", "url")


# Classification.
def block_sql() -> str:
    cases = []
    for r in R.RETAILERS:
        markers = [m.lower() for m in r.block_markers]
        if r.block_text in ("folded_body", "decoded_body"):
            text = folded("body_text")
            markers = [m.translate(str.maketrans("áéíóúü", "aeiouu")) for m in markers]
        elif r.block_text == "spaced_html":
            text = f"regexp_replace(lower(html), '{SPACE}', ' ', 'g')"
        elif r.block_text == "title_and_body":
            text = "lower(title || chr(10) || body_text)"
        else:
            text = "lower(body_text)"
        tests = [f"contains({text}, {V.quote(m)})" for m in markers]
        if r.block_statuses:
            tests.append(f"coalesce(status, 0) in ({', '.join(map(str, r.block_statuses))})")
        if r.block_url:
            tests.append(f"contains(lower(url), '{r.block_url}')")
        cases.append(f"when '{r.retailer_id}' then {' or '.join(tests)}")
    return "case retailer_id " + " ".join(cases) + " end"


@query("classify_block", f"with {V.TEXTS_CTE} select doc_id, retailer_id, {block_sql()} as blocked from texts")
def classify_block(spark, sf):
    return classify_blocks(V.texts(spark, sf)).select("doc_id", "retailer_id", "blocked")


OUTCOME_SQL = (
    "case when status is null or (retailer_id = 'farmacias-del-ahorro' and status not between 200 and 299) "
    "then 'NETWORK_UNAVAILABLE' when status >= 400 then 'ERROR' else 'OK' end"
)


@query("classify_http", f"with {V.TEXTS_CTE} select doc_id, {OUTCOME_SQL} as outcome from texts")
def classify_http(spark, sf):
    return classify_outcomes(V.texts(spark, sf)).select("doc_id", "outcome")


# Store evidence: page text and session state derived from line items, for the two retailers with stores.
EVIDENCE = {
    "run_id": "l_orderkey",
    "page_number": "l_linenumber",
    "position": "l_suppkey",
    "part_id": "l_partkey",
    "retailer_id": "case when l_suppkey % 2 = 0 then 'walmart' else 'chedraui' end",
    "store": "case when l_suppkey % 2 = 0 then 'SC Toreo' else 'Chedraui Selecto México Polanco' end",
    "postal_code": "case when l_suppkey % 2 = 0 then '11220' else '11500' end",
    "store_id": "case when l_suppkey % 2 = 0 then '2344' else '232' end",
    "body_text": (
        "p_name || case l_linenumber when 1 then ' Tienda SC  TOREO Blvd CMX 11220' when 2 then ' Pickup hoy en SC TOREO'"
        " when 3 then ' Pickup sin costo' when 4 then ' Recoger en Chedraui Selecto México Polanco'"
        " when 5 then ' Polanco #232' when 6 then ' SC Toreo, recógelo; envío a Polanco' else ' Santa Fe 01219 11500 11220' end"
    ),
    "state_blob": (
        "case l_partkey % 5 when 0 then '{\"id\":\"2344\",\"name\":\"SC%20Toreo\"}' when 1 then '{\"postalCode\":\"11220\"}'"
        " when 2 then '{\"storeName\":\"Selecto Polanco\",\"storeId\":\"9\"}' when 3 then '{\"polanco\":1,\"p\":\"11500\"}' else '{}' end"
    ),
}
EVIDENCE_CTE = (
    "evidence as (select " + ", ".join(f"{e} as {n}" for n, e in EVIDENCE.items())
    + " from lineitem join part on l_partkey = p_partkey)"
)


def evidence_rows(spark, sf):
    return V.line_parts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in EVIDENCE.items()])


BODY, BLOB = folded("body_text"), folded("replace(state_blob, '%20', ' ')")
TEXT_SQL = (
    f"case when retailer_id = 'walmart' then contains({BODY}, 'sc toreo') and (contains({BODY}, '11220') or contains({BODY}, '2344') "
    f"or regexp_matches({BODY}, '(pickup|recog).{{0,100}}sc toreo|sc toreo.{{0,100}}(pickup|recog)')) "
    f"else contains({BODY}, 'polanco') and (contains({BODY}, '232') or contains({BODY}, '11500') or contains({BODY}, 'selecto mexico polanco') "
    f"or regexp_matches({BODY}, '(recoger|pickup|tienda).{{0,140}}polanco|polanco.{{0,140}}(recoger|pickup|tienda)')) end"
)
STATE_SQL = (
    f"case when retailer_id = 'walmart' then cast(contains({BLOB}, 'sc toreo') as int) + cast(contains({BLOB}, '11220') as int) + cast(contains({BLOB}, '2344') as int) >= 2 "
    f"else contains({BLOB}, 'polanco') and 1 + cast(contains({BLOB}, '232') as int) + cast(contains({BLOB}, '11500') as int) + cast(contains({BLOB}, 'selecto') as int) >= 2 end"
)


def proved(rows, source, column):
    """Rows with the outcome of one proof alone."""
    return verify_stores(rows.drop(*[c for c in ("body_text", "state_blob") if c != source])).withColumnRenamed(
        "store_context_verified", column
    )


@query("store_evidence_text", f"with {EVIDENCE_CTE} select {KEYS}, {TEXT_SQL} as proved from evidence")
def store_evidence_text(spark, sf):
    return proved(evidence_rows(spark, sf), "body_text", "proved").select(*KEY, "proved")


@query("store_evidence_state", f"with {EVIDENCE_CTE} select {KEYS}, {STATE_SQL} as proved from evidence")
def store_evidence_state(spark, sf):
    return proved(evidence_rows(spark, sf), "state_blob", "proved").select(*KEY, "proved")


# What a session saw after picking the store, and on a detail page.
LATER = {
    "after_ui_text": "case when part_id % 7 = 1 then 'sc toreo 11220' end",
    "after_ui_state": "case when part_id % 7 = 2 then '{\"2344\": \"SC Toreo\"}' end",
    "detail_text": "case when part_id % 7 = 3 then 'Recoger hoy en SC Toreo' end",
    "detail_state": "case when part_id % 7 = 4 then '11220 SC Toreo' end",
}


@query(
    "store_verification",
    f"with {EVIDENCE_CTE}, tagged as (select *, case when {TEXT_SQL} then case when retailer_id = 'walmart' then 'category_text' else 'page_text' end "
    f"when {STATE_SQL} then 'browser_state' when retailer_id = 'walmart' then case part_id % 7 when 1 then 'category_text_after_ui' "
    "when 2 then 'browser_state_after_ui' when 3 then 'product_detail_pickup_store' when 4 then 'product_detail_browser_state' end end "
    "as store_context_method from evidence) "
    f"select {KEYS}, store_context_method is not null as store_context_verified, store_context_method from tagged",
)
def store_verification(spark, sf):
    """Text, then state, then the text after the store was picked, then a detail page."""
    rows = verify_stores(evidence_rows(spark, sf).withColumns({n: F.expr(e) for n, e in LATER.items()}))
    return rows.select(*KEY, "store_context_verified", "store_context_method")


# Documents as the pages of sessions: ten pages per retailer and run.
SESSION_PAGES = {
    "doc_id": "doc_id",
    "retailer_id": "retailer_id",
    "category_id": "'c'",
    "location_id": "case retailer_id " + " ".join(f"when {V.quote(r.retailer_id)} then {V.quote(r.location_id)}" for r in R.RETAILERS) + " end",
    "run_id": "cast(floor(doc_id / 60) as bigint)",
    "page_number": "cast(floor((doc_id % 60) / 6) as int) + 1",
    "status": "status",
    "url": "url",
    "title": "title",
    "html": "html",
    "body_text": "body_text || case doc_id % 4 when 0 then ' SC Toreo 11220' when 1 then ' Polanco 232' else '' end",
    "state_blob": "case when doc_id % 9 = 2 then 'SC Toreo 2344' when doc_id % 9 = 3 then 'polanco 11500' else '' end",
}


def evidence_at(proof: str) -> str:
    """The evidence tests with a missing value for a missing state."""
    return f"coalesce({proof}, false)"


@query(
    "usable_pages",
    f"with {V.TEXTS_CTE}, s as (select " + ", ".join(f"{e} as {n}" for n, e in SESSION_PAGES.items())
    + f" from texts), f as (select *, {block_sql()} as blocked, case when retailer_id in ('walmart', 'chedraui') then "
    f"case when {evidence_at(TEXT_SQL)} then case when retailer_id = 'walmart' then 'category_text' else 'page_text' end when {evidence_at(STATE_SQL)} then 'browser_state' end end as direct_method from s), "
    "first_pages as (select retailer_id, run_id, direct_method as first_method from f where page_number = 1) "
    "select f.doc_id, f.retailer_id, f.page_number, case when first_method is null then null when page_number = 1 then direct_method else coalesce(direct_method, 'session:' || first_method) end as page_method, "
    "first_method as store_context_method from f left join first_pages p on f.retailer_id = p.retailer_id and f.run_id = p.run_id "
    "where not blocked and status is not null and status < 400 and not (f.retailer_id = 'farmacias-del-ahorro' and status not between 200 and 299) "
    "and (f.retailer_id not in ('walmart', 'chedraui') or first_method is not null)",
)
def usable_pages_query(spark, sf):
    pages = V.texts(spark, sf).selectExpr(*[f"{e} as {n}" for n, e in SESSION_PAGES.items()])
    usable = usable_pages(pages, dim_location(spark))
    return usable.select("doc_id", "retailer_id", "page_number", "page_method", "store_context_method")


# Brands from a table. A theta join says the same; RE2 has no look-around, so the neighbours are spelled out.
def theta_sql(ctes: str, select: str, on: str = "true") -> str:
    escaped = r"regexp_replace(lower(brand), '([^\pL\pN_ ])', '\\\1', 'g')"
    stands = rf"regexp_matches(lower(product), '(^|[^\pL\pN_])' || {escaped} || '($|[^\pL\pN_])')"
    return (
        f"with {ctes}, texts as (select distinct {select}product from named), "
        f"hits as materialized (select {select and 'r.' + select}r.product, b.brand, b.priority from texts r join brands b "
        f"on {on} and contains(lower(r.product), lower(b.brand))), "
        f"firsts as (select {select}product, arg_min(brand, priority) as brand from hits where {stands} group by all) "
    )


MAKERS = {"brand": "c_name", "priority": "c_custkey"}
MADE = {
    "o_orderkey": "o_orderkey",
    "product": "case o_orderkey % 5 when 0 then upper(c_name) || ' 90 ml' when 1 then 'Porta' || lower(c_name) when 2 then 'Caja (' || c_name || ') 2 pz' "
    "when 3 then c_name || '0 y Customer#' || right(cast(1000000001 + o_custkey as string), 9) else 'Customer# sin marca' end",
}


def listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in columns.items())


@query(
    "brand_index_makers",
    theta_sql(
        f"named as (select {listed(MADE)} from orders join customer on o_custkey = c_custkey), brands as (select {listed(MAKERS)} from customer)", ""
    )
    + "select o_orderkey, n.product, f.brand as inferred from named n left join firsts f on f.product = n.product",
)
def brand_index_makers(spark, sf):
    """A dictionary that grows with the tables: one word stands in all of its brands, the other in one."""
    customers = V.table(spark, sf, "customer")
    named = V.table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    named = named.selectExpr(*[f"{e} as {n}" for n, e in MADE.items()])
    return match_brands(named, customers.selectExpr(*[f"{e} as {n}" for n, e in MAKERS.items()]))


BRAND_LISTS = [(r.retailer_id, i, b) for r in R.RETAILERS for i, b in enumerate(dict.fromkeys(r.brands))]


@query(
    "brand_index_retailers",
    theta_sql(
        f"{V.CARDS_CTE}, named as (select * from cards), brands(retailer_id, priority, brand) as (values "
        + ", ".join(f"({V.quote(r)}, {i}, {V.quote(b)})" for r, i, b in BRAND_LISTS)
        + ")",
        "retailer_id, ",
        "r.retailer_id = b.retailer_id",
    )
    + f"select {', '.join('n.' + k for k in KEY)}, n.product, f.brand as inferred from named n left join firsts f "
    "on f.product = n.product and f.retailer_id = n.retailer_id",
)
def brand_index_retailers(spark, sf):
    """Every retailer's own list as one table."""
    brands = spark.createDataFrame(BRAND_LISTS, "retailer_id string, priority int, brand string")
    return match_brands(V.cards(spark, sf), brands, by=("retailer_id",)).select(*KEY, "product", "inferred")
