"""Table-wide normalisation jobs; every step is a column expression, so each job is one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.brands import infer_brand
from anaquel.functions.text import clean_text, fallback_title
from anaquel.functions.urls import absolute_url, page_url, sku_dash_html, sku_from_url, sku_p_path


def display_name(retailer_id: Column) -> Column:
    """Display name of a retailer; an unknown id stands for itself."""
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in R.RETAILERS:
        name = name.when(retailer_id == r.retailer_id, F.lit(r.display_name))
    return name.otherwise(retailer_id)


def base_url(retailer_id: Column) -> Column:
    url = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in R.RETAILERS:
        url = url.when(retailer_id == r.retailer_id, F.lit(r.base_url))
    return url


def normalise_listings(df: DataFrame) -> DataFrame:
    """Clean names, titles, time stamps and the retailer's display name."""
    return df.withColumns(
        {
            "retailer": display_name(F.col("retailer_id")),
            "product": fallback_title(F.col("product"), F.col("text")),
            "text": clean_text(F.col("text")),
            "scrape_timestamp": F.col("scrape_timestamp_raw").try_cast("timestamp"),
        }
    )


def retailer_sku(retailer_id: str, url: Column, pid: Column) -> Column:
    if retailer_id == "farmacias-guadalajara":
        return sku_dash_html(url, pid)
    if retailer_id == "farmacias-san-pablo":
        return F.coalesce(clean_text(pid), sku_p_path(url))
    if retailer_id in ("walmart", "chedraui"):
        return sku_from_url(url)
    return sku_from_url(url, pid)


def assign_sku(df: DataFrame) -> DataFrame:
    """SKU by each retailer's own rule."""
    sku = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in R.RETAILERS:
        sku = sku.when(
            F.col("retailer_id") == r.retailer_id, retailer_sku(r.retailer_id, F.col("url"), F.col("data_pid"))
        )
    return df.withColumn("sku", sku)


def canonicalise_urls(df: DataFrame, href: str = "href") -> DataFrame:
    return df.withColumn("url", absolute_url(F.col(href), base_url(F.col("retailer_id"))))


def listing_page_url(retailer_id: Column, url: Column, page: Column) -> Column:
    """Address of a listing page, by the parameter each retailer uses."""
    address = F.when(F.lit(False), F.lit(None).cast("string"))
    for parameter in ("page", "p", "currentPage"):
        ids = [r.retailer_id for r in R.RETAILERS if r.page_parameter == parameter]
        address = address.when(retailer_id.isin(*ids), page_url(url, page, parameter))
    return address


def infer_brands(df: DataFrame) -> DataFrame:
    """Brand by each retailer's rule where the row has none of its own."""
    own = clean_text(F.col("brand"))
    inferred = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in R.RETAILERS:
        inferred = inferred.when(
            F.col("retailer_id") == r.retailer_id, infer_brand(r, F.col("product"), F.col("text"))
        )
    return df.withColumn("brand", F.coalesce(own, inferred))
