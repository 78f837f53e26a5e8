"""Cases: which listings a full run has to visit, and how each run ended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.classify import classify_case, reported_products
from anaquel.operators.normalise import display_name


def case_grid(dim_category: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Every enabled category of every retailer with the retailer's own location."""
    location = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in R.RETAILERS:
        location = location.when(F.col("retailer_id") == r.retailer_id, F.lit(r.location_id))
    cases = dim_category.withColumn("location_id", location)
    return cases.join(dim_location.select("location_id", "store"), "location_id").select(
        "retailer_id",
        display_name(F.col("retailer_id")).alias("retailer"),
        "category_id",
        "department",
        F.col("name").alias("category"),
        "subcategory",
        "sub_subcategory",
        "location_id",
        "store",
    )


def classify_cases(case_log: DataFrame) -> DataFrame:
    """Status and reported product count of each run from its exit code and log."""
    return case_log.withColumns(
        {
            "status": classify_case(F.col("exit_code"), F.col("log_text")),
            "reported_products": reported_products(F.col("log_text")),
        }
    )


def grid_responses(responses: DataFrame) -> DataFrame:
    """Responses that fed the product grid: time, status, address and body length or read error."""
    marked = F.contains("url", F.lit(R.GRID_MARKERS[0]))
    for m in R.GRID_MARKERS[1:]:
        marked = marked | F.contains("url", F.lit(m))
    return responses.where(marked).select(
        "ts",
        "status",
        "url",
        F.length("body").alias("body_length"),
        F.when(F.col("body").isNull(), F.col("read_error")).alias("read_error"),
    )
