"""The fixed observation schema and the keys that the jobs share."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Column order of one product observation.
OBSERVATION = T.StructType(
    [
        T.StructField("scrape_timestamp", T.TimestampType()),
        T.StructField("retailer", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("store", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("sub_subcategory", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("price_current", MONEY),
        T.StructField("price_regular", MONEY),
        T.StructField("promotion", T.StringType()),
        T.StructField("pickup_available", T.BooleanType()),
        T.StructField("store_context_verified", T.BooleanType()),
        T.StructField("store_context_method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("price_raw", T.StringType()),
    ]
)
OBSERVATION_COLUMNS = OBSERVATION.fieldNames()

# Spark rows have no order of their own: these columns say where in a run a row
# was seen, and every "first" or "last" in the jobs means first or last in them.
SEQUENCE = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("position", T.LongType()),
    ]
)
SEQUENCE_COLUMNS = SEQUENCE.fieldNames()

TRACKED = T.StructType(OBSERVATION.fields + SEQUENCE.fields)

SLICE = ["retailer", "category_id", "city", "store_id"]
SUMMARY_KEY = ["retailer", "category_id", "city", "store", "store_id"]
CONSOLIDATED_KEY = SLICE + ["sku", "url"]
PARTITION = ["retailer", "category_id"]

CATEGORY = T.StructType(
    [
        T.StructField("retailer_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("sub_subcategory", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("location_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("store", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
    ]
)

CAPTURE = T.StructType(
    [
        T.StructField("retailer_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("body_text", T.StringType()),
        T.StructField("state_blob", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

CASE_LOG = T.StructType(
    [
        T.StructField("retailer_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("exit_code", T.IntegerType()),
        T.StructField("log_text", T.StringType()),
    ]
)

SEARCH_PAYLOAD = (
    "struct<catalog: struct<"
    "content: array<struct<sku: string, ecommTitle: string, ecommBrand: string, ecommUrlKey: string,"
    " currentPrice: string, previousPrice: string>>,"
    " pagination: struct<total: bigint>>>"
)

_NAMED = "array<struct<name: string>>"
PRODUCT_SEARCH_PAYLOAD = (
    "struct<data: struct<productSearch: struct<recordsFiltered: bigint, products: array<struct<"
    "productId: string, productReference: string, productName: string, brand: string, link: string,"
    " items: array<struct<sellers: array<struct<sellerDefault: boolean, commertialOffer: struct<"
    "Price: decimal(12,2), ListPrice: decimal(12,2), AvailableQuantity: bigint,"
    f" discountHighlights: {_NAMED}, teasers: {_NAMED}>>>>>,"
    " priceRange: struct<sellingPrice: struct<lowPrice: decimal(12,2)>,"
    " listPrice: struct<lowPrice: decimal(12,2)>>>>>>>"
)
