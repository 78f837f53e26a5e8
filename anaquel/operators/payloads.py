"""JSON payloads to product rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.brands import infer_brand
from anaquel.functions.money import evidence_json
from anaquel.functions.promotions import offer_labels, percent_computed
from anaquel.functions.text import blank_to_null, clean_text, once
from anaquel.functions.urls import absolute_url
from anaquel.operators.prices import resolve_prices
from anaquel.schema import MONEY, PRODUCT_SEARCH_PAYLOAD, SEARCH_PAYLOAD


def scan_search_payloads(pages: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """One row per item of a search page; a page without items keeps one row with a null item."""
    parsed = pages.select(*keys, once(F.from_json(payload, SEARCH_PAYLOAD)).alias("_p"))
    content = F.coalesce(F.col("_p.catalog.content"), F.array().cast(parsed.schema["_p"].dataType["catalog"].dataType["content"].dataType))
    return parsed.select(
        *keys,
        F.coalesce(F.col("_p.catalog.pagination.total"), F.lit(0)).alias("total"),
        F.size(content).alias("n_items"),
        F.posexplode_outer(content).alias("position", "item"),
    )


def map_search_items(items: DataFrame, keys: list[str]) -> DataFrame:
    """Search items to observations; an item without sku, title, address key or price is dropped."""
    retailer = R.BY_ID["farmacias-del-ahorro"]
    item = F.col("item")
    cleaned = items.select(
        *keys,
        "position",
        clean_text(item["sku"]).alias("sku"),
        clean_text(item["ecommTitle"]).alias("product"),
        clean_text(item["ecommUrlKey"]).alias("url_key"),
        clean_text(item["ecommBrand"]).alias("_brand"),
        item["currentPrice"].alias("current_price"),
        item["previousPrice"].alias("previous_price"),
    )
    priced = resolve_prices(cleaned, "previous").where(
        "sku is not null and product is not null and url_key is not null and price_current is not null"
    )
    current, regular = F.col("price_current"), F.col("price_regular")
    raw = evidence_json(
        currentPrice=F.col("current_price").try_cast("double"), previousPrice=F.col("previous_price").try_cast("double")
    )
    return priced.select(
        *keys,
        "position",
        F.lit(retailer.display_name).alias("retailer"),
        "sku",
        F.coalesce(F.col("_brand"), infer_brand(retailer, F.col("product"))).alias("brand"),
        "product",
        "price_current",
        "price_regular",
        percent_computed(current, regular).alias("promotion"),
        F.lit(None).cast("boolean").alias("pickup_available"),
        F.lit(False).alias("store_context_verified"),
        F.lit("online_catalog_empathy_nacional").alias("store_context_method"),
        absolute_url(F.concat("url_key", F.lit(".html")), retailer.base_url).alias("url"),
        raw.alias("price_raw"),
    )


def scan_product_search(pages: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """One row per product of a range payload, with the listing's record count."""
    parsed = pages.select(*keys, once(F.from_json(payload, PRODUCT_SEARCH_PAYLOAD)).alias("_p"))
    found = F.col("_p.data.productSearch")
    return parsed.select(
        *keys, found["recordsFiltered"].alias("records_filtered"), F.posexplode(found["products"]).alias("position", "found")
    )


def best_offer(found: Column) -> Column:
    """Best offer over a product's items and sellers: in stock before merely priced, the default
    seller before others, then document order. Without a priced offer the price range counts.

    The offers lie inside the row, so choosing one is an array minimum and needs no shuffle.
    """

    def offer(seller: Column) -> Column:
        o = seller["commertialOffer"]
        priced = o["Price"] > 0
        stocked = o["AvailableQuantity"].isNull() | (o["AvailableQuantity"] > 0)
        return F.struct(
            F.when(priced & stocked, 0).when(priced, 1).otherwise(2).alias("tier"),
            F.when(seller["sellerDefault"], 0).otherwise(1).alias("seller"),
            o["Price"].alias("price"),
            o["ListPrice"].alias("listed"),
            o["AvailableQuantity"].alias("quantity"),
            o["discountHighlights"].alias("highlights"),
            o["teasers"].alias("teasers"),
        )

    offers = F.flatten(
        F.transform(found["items"], lambda i: F.coalesce(F.transform(i["sellers"], offer), F.array()))
    )
    placed = F.transform(
        offers,
        lambda o, at: F.struct(
            o["tier"].alias("tier"), o["seller"].alias("seller"), at.alias("place"), o.alias("offer")
        ),
    )
    return F.array_min(F.filter(placed, lambda o: o["tier"] < 2))["offer"]


def map_product_search(products: DataFrame, keys: list[str], method: str = "page_text") -> DataFrame:
    """Range products to observations."""
    retailer = R.BY_ID["chedraui"]
    found = F.col("found")
    chosen = products.select(
        *keys,
        "position",
        "records_filtered",
        clean_text(F.coalesce(blank_to_null(found["productId"]), found["productReference"])).alias("sku"),
        clean_text(found["productName"]).alias("product"),
        absolute_url(found["link"], retailer.base_url).alias("url"),
        clean_text(found["brand"]).alias("_brand"),
        found["priceRange"].alias("_range"),
        once(best_offer(found)).alias("_offer"),
    )
    offer = F.col("_offer")
    now = F.coalesce(offer["price"], F.col("_range.sellingPrice.lowPrice"))
    listed = F.when(offer.isNotNull(), offer["listed"]).otherwise(F.col("_range.listPrice.lowPrice"))
    priced = (
        chosen.withColumn("_now", now)
        .withColumn("_listed", F.when(listed > 0, listed).otherwise(F.col("_now")))
        .where("sku is not null and product is not null and url is not null and _now is not null")
    )
    current, regular = F.least("_now", "_listed"), F.greatest("_now", "_listed")
    return priced.select(
        *keys,
        "position",
        "records_filtered",
        F.lit(retailer.display_name).alias("retailer"),
        "sku",
        F.coalesce(F.col("_brand"), infer_brand(retailer, F.col("product"))).alias("brand"),
        "product",
        current.cast(MONEY).alias("price_current"),
        regular.cast(MONEY).alias("price_regular"),
        offer_labels(offer["highlights"], offer["teasers"], current, regular).alias("promotion"),
        (offer["quantity"].isNull() | (offer["quantity"] > 0)).alias("pickup_available"),
        F.lit(True).alias("store_context_verified"),
        F.lit(f"{method}+productSearchV3").alias("store_context_method"),
        "url",
        F.format_string("productSearchV3 Price=%s ListPrice=%s", current.cast("double"), regular.cast("double")).alias("price_raw"),
    )
