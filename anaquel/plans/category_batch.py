"""All categories of a run in one plan: stamp, conform, dedup; and what had to be left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.operators.dedup import dedup_sku_url
from anaquel.operators.normalise import display_name
from anaquel.operators.shape import conform_schema, mark_missing, stamp_category, stamp_location
from anaquel.schema import SLICE

UNKNOWN_CATEGORY, UNKNOWN_LOCATION = "unknown category", "unknown location"


class UnknownKeys(ValueError):
    """Rows name categories or locations that the dimensions do not hold."""


def judged_rows(rows: DataFrame, dim_category: DataFrame, dim_location: DataFrame) -> DataFrame:
    """All rows with ``reject_reason``: the first missing field, or the dimension that does not know the row."""
    categories = dim_category.select("retailer_id", "category_id", F.lit(True).alias("_category")).distinct()
    locations = dim_location.select("location_id", F.lit(True).alias("_location")).distinct()
    known = mark_missing(rows).join(categories, ["retailer_id", "category_id"], "left").join(locations, "location_id", "left")
    unknown = F.when(F.col("_category").isNull(), UNKNOWN_CATEGORY).when(F.col("_location").isNull(), UNKNOWN_LOCATION)
    return known.withColumn("reject_reason", F.coalesce("reject_reason", unknown)).drop("_category", "_location")


def category_batch(
    rows: DataFrame, dim_category: DataFrame, dim_location: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Extracted rows with ``retailer_id``, ``category_id`` and ``location_id`` to one clean batch, and the rejected
    rows with their reason. ``strict`` raises if a category or location is unknown."""
    judged = judged_rows(rows, dim_category, dim_location)
    rejected = judged.where(F.col("reject_reason").isNotNull())
    if strict:
        keys = ["retailer_id", "category_id", "location_id", "reject_reason"]
        unknown = rejected.where(F.col("reject_reason").isin(UNKNOWN_CATEGORY, UNKNOWN_LOCATION)).select(*keys).distinct().take(5)
        if unknown:
            raise UnknownKeys(", ".join(str(r.asDict()) for r in unknown))
    kept = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    placed = stamp_location(stamp_category(kept, dim_category), dim_location)
    named = placed.withColumn("retailer", display_name(F.col("retailer_id")))
    return dedup_sku_url(conform_schema(named), SLICE), rejected
