"""Row-shape jobs: fixed schema, dimension stamps, mandatory fields, simple filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.text import is_blank
from anaquel.schema import OBSERVATION, SEQUENCE_COLUMNS


def conform_schema(df: DataFrame, keep_sequence: bool = True) -> DataFrame:
    """Pad missing columns with null, drop extra ones, fix order and types."""
    present = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in OBSERVATION
    ]
    sequence = [c for c in SEQUENCE_COLUMNS if c in present] if keep_sequence else []
    return df.select(*columns, *sequence)


def _category_columns(dim: DataFrame) -> DataFrame:
    return dim.select(
        "retailer_id",
        "category_id",
        F.col("department").alias("dim_department"),
        F.col("name").alias("dim_category"),
        F.col("subcategory").alias("dim_subcategory"),
        F.col("sub_subcategory").alias("dim_sub_subcategory"),
    )


def stamp_category(df: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Overwrite the category hierarchy from the dimension; rows without an entry drop out here and
    are reported by :func:`unknown_categories`."""
    levels = ["department", "category", "subcategory", "sub_subcategory"]
    joined = df.drop(*levels).join(_category_columns(dim_category), ["retailer_id", "category_id"])
    return joined.withColumnsRenamed({f"dim_{c}": c for c in levels})


def unknown_categories(df: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Keys that the dimension does not know, with their row counts."""
    keys = df.groupBy("retailer_id", "category_id").agg(F.count("*").alias("orphan_rows"))
    return keys.join(dim_category, ["retailer_id", "category_id"], "left_anti")


def stamp_location(df: DataFrame, dim_location: DataFrame) -> DataFrame:
    place = ["city", "state", "postal_code", "store", "store_id"]
    return df.drop(*place).join(dim_location.select("location_id", *place), "location_id")


def unknown_locations(df: DataFrame, dim_location: DataFrame) -> DataFrame:
    keys = df.groupBy("location_id").agg(F.count("*").alias("orphan_rows"))
    return keys.join(dim_location, "location_id", "left_anti")


FIELD_ORDER = ["sku", "product", "url", "price_current"]


def missing_field(retailer_id: Column, columns: dict[str, Column]) -> Column:
    """Name of the first mandatory field that a row lacks; null when the row is complete.

    Each column is tested once, for the retailers that require it.
    """
    gaps = []
    for name in FIELD_ORDER:
        requiring = [r.retailer_id for r in R.RETAILERS if name in r.required]
        lacking = columns[name].isNull() if name == "price_current" else is_blank(columns[name])
        gaps.append(F.when(retailer_id.isin(*requiring) & lacking, F.lit(name)))
    return F.coalesce(*gaps)


def mark_missing(df: DataFrame) -> DataFrame:
    fields = {c: F.col(c) for c in FIELD_ORDER}
    return df.withColumn("reject_reason", missing_field(F.col("retailer_id"), fields))


def require_fields(df: DataFrame) -> DataFrame:
    return mark_missing(df).where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(df: DataFrame) -> DataFrame:
    return mark_missing(df).where(F.col("reject_reason").isNotNull())


def pickup_only(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.col(text).rlike(R.PICKUP))


def valid_price(df: DataFrame, price: str = "price_current") -> DataFrame:
    return df.where(F.col(price) > 0)


def product_link(retailer_id: Column, href: Column) -> Column:
    verdict = F.when(F.lit(False), F.lit(False))
    for r in R.RETAILERS:
        verdict = verdict.when(retailer_id == r.retailer_id, href.rlike(r.link_pattern))
    return F.coalesce(verdict, F.lit(False))


def product_link_filter(df: DataFrame, href: str = "href") -> DataFrame:
    return df.where(product_link(F.col("retailer_id"), F.col(href)))


# Shortest and longest card text that counts as a price card.
CARD_LENGTH = {"walmart": (21, None), "chedraui": (21, 2999), "farmacias-guadalajara": (15, 3000)}


def price_card(retailer_id: Column, text: Column) -> Column:
    """Does the text hold money and have a card's length?"""
    shortest = longest = F.when(F.lit(False), F.lit(0))
    for name, (low, high) in CARD_LENGTH.items():
        shortest = shortest.when(retailer_id == name, F.lit(low))
        if high:
            longest = longest.when(retailer_id == name, F.lit(high))
    size = F.length(text)
    return size.between(shortest.otherwise(0), longest.otherwise(2**31 - 1)) & text.rlike(R.MONEY_LOOSE)


def price_card_filter(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(price_card(F.col("retailer_id"), F.col(text)))


def page_limit(df: DataFrame, pages: int, page: str = "page_number") -> DataFrame:
    """First ``pages`` pages of each listing; zero or less means all."""
    return df.where(F.col(page) <= pages) if pages > 0 else df
