"""From landed pages and payloads to observations: one plan per source form, joined into one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.brands import infer_brand
from anaquel.functions.html import html_nodes
from anaquel.functions.text import clean_text, fallback_title
from anaquel.operators.dedup import dedup_in_page
from anaquel.operators.listing_html import cards_in_nodes, product_details, resolve_links
from anaquel.operators.normalise import retailer_sku
from anaquel.operators.payloads import (
    map_product_search,
    map_search_items,
    scan_product_search,
    scan_search_payloads,
)
from anaquel.operators.prices import extract_promotions, resolve_prices
from anaquel.operators.shape import pickup_only, require_fields
from anaquel.operators.slices import detail_or_card, union_retailers
from anaquel.session import materialise

# Price and promotion rule of each retailer's listing cards.
CARD_FORMS = {
    "soriana": ("listed", "badges"),
    "walmart": ("labelled", "shelf_labels"),
    "chedraui": ("selected", "badges"),
    "farmacias-guadalajara": ("first_last", "multibuy"),
    "farmacias-san-pablo": ("min_max", "percent_text"),
}

# How rows of retailers without store pages say where they come from.
ONLINE_METHOD = {
    "farmacias-guadalajara": "online_catalog_no_store_requested",
    "farmacias-san-pablo": "online_catalog_category_card_fallback",
}
DETAIL_METHOD = "online_catalog_product_detail_h3_priceTotal"
DETAIL_RETAILER = "farmacias-san-pablo"

# Columns of a capture that its rows keep when it has them.
CARRIED = ["fetched_at", "store_context_method"]


def _evidence(retailer_id: str) -> Column:
    """What the prices were read from."""
    if retailer_id in ("soriana", "chedraui"):
        return clean_text(F.array_join("price_texts", " | "))
    return clean_text(F.col("text"))


def _provenance(rows: DataFrame, online: str | None) -> DataFrame:
    """Time of capture and store context: proved by the capture, or named for an online catalogue."""
    has = set(rows.columns)
    proved = F.col("store_context_method") if "store_context_method" in has else F.lit(None).cast("string")
    seen_at = F.col("fetched_at") if "fetched_at" in has else F.lit(None).cast("timestamp")
    return rows.withColumns(
        {
            "scrape_timestamp": seen_at,
            "store_context_verified": F.lit(False) if online else proved.isNotNull(),
            "store_context_method": F.lit(online) if online else proved,
        }
    )


def _as_rows(rows: DataFrame, page: list[str]) -> DataFrame:
    return require_fields(rows).select(
        *page,
        "position",
        "scrape_timestamp",
        "sku",
        "brand",
        "product",
        "price_current",
        "price_regular",
        "promotion",
        "pickup_available",
        "store_context_verified",
        "store_context_method",
        "url",
        "price_raw",
    )


def observations_from_cards(cards: DataFrame, retailer_id: str, page: list[str]) -> DataFrame:
    """Cards of one retailer to rows with resolved price, promotion, SKU, brand and address."""
    prices, promotions = CARD_FORMS[retailer_id]
    retailer = R.BY_ID[retailer_id]
    rows = dedup_in_page(cards.withColumnRenamed("data_pid", "code"), page).withColumnRenamed("code", "data_pid")
    rows = rows.withColumns({"product": clean_text(F.col("product")), "price_raw": _evidence(retailer_id)})
    if retailer_id == "walmart":
        rows = pickup_only(rows)
    rows = resolve_links(extract_promotions(resolve_prices(rows, prices), promotions), retailer_id)
    brand = F.coalesce(clean_text(F.col("brand")), infer_brand(retailer, F.col("product"), F.col("text")))
    rows = rows.withColumns(
        {
            "brand": brand,
            "sku": retailer_sku(retailer_id, F.col("url"), F.col("data_pid")),
            "pickup_available": F.lit(True) if retailer.store_hints else F.lit(None).cast("boolean"),
        }
    )
    return _as_rows(_provenance(rows, ONLINE_METHOD.get(retailer_id)), page)


def observations_from_details(captures: DataFrame, page: list[str]) -> DataFrame:
    """Product detail pages to rows."""
    rows = product_details(captures, [*dict.fromkeys([*page, "url"])]).withColumns(
        {"position": F.lit(0), "pickup_available": F.lit(None).cast("boolean")}
    )
    return _as_rows(_provenance(rows, DETAIL_METHOD), page)


def _fallback_cards(cards: DataFrame) -> DataFrame:
    """Priced cards with a code and no link, named by their title."""
    coded = cards.where(
        F.col("href").isNull() & clean_text(F.col("data_pid")).isNotNull() & F.contains("text", F.lit("$"))
    )
    return coded.withColumn("product", fallback_title(F.col("product"), F.col("text")))


def cards_of_all(captures: DataFrame, keys: list[str]) -> DataFrame:
    """Cards of all retailers' pages: every page is read and parsed once, and its nodes are written by retailer;
    each retailer's rule then reads its own nodes only."""
    nodes = materialise(html_nodes(captures, keys), "nodes", ("retailer_id",))
    return union_retailers([cards_in_nodes(nodes.where(F.col("retailer_id") == r), r, keys) for r in CARD_FORMS])


def observations_from_pages(captures: DataFrame, page: list[str], slice_cols: list[str] | None = None) -> DataFrame:
    """All retailers' pages to observations.

    ``page`` names the columns that identify a capture, ``slice_cols`` those of a listing (by default
    all of ``page`` but the page number). Cards are written once: parsing markup is the dear step,
    and five branches read its result. One retailer's rows come from its product pages, and from
    cards only for listings that show no product address at all.
    """
    page = [*dict.fromkeys(["retailer_id", *page])]
    slice_cols = slice_cols or [c for c in page if c not in ("page_number", "attempt")]
    keys = [*page, *[c for c in CARRIED if c in captures.columns]]
    is_detail = (F.col("retailer_id") == DETAIL_RETAILER) & F.col("url").rlike(R.SKU_P_PATH)
    listings = captures.where(~F.coalesce(is_detail, F.lit(False)))
    cards = materialise(cards_of_all(listings, keys), "cards", ("retailer_id",))

    def of(retailer_id: str) -> DataFrame:
        return cards.where(F.col("retailer_id") == retailer_id)

    frames = [observations_from_cards(of(r), r, page) for r in CARD_FORMS if r != DETAIL_RETAILER]
    linked = of(DETAIL_RETAILER)
    details = observations_from_details(captures.where(is_detail), page)
    fallback = observations_from_cards(_fallback_cards(linked), DETAIL_RETAILER, page)
    frames.append(detail_or_card(details, fallback, linked.where(F.col("href").isNotNull()), slice_cols))
    return union_retailers(frames)


def observations_from_payloads(search_pages: DataFrame, range_pages: DataFrame, page: list[str]) -> DataFrame:
    """Search and range payloads to rows."""
    searched = map_search_items(scan_search_payloads(search_pages, page), page)
    ranged = map_product_search(scan_product_search(range_pages, page), page)
    return union_retailers([searched, ranged.drop("records_filtered")])
