"""Which captures may yield rows: answered, not blocked, and proved for their store where that matters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.operators.paging import first_methods, session_verified
from anaquel.operators.screening import classify_blocks, classify_outcomes, verify_stores
from anaquel.session import broadcast_if_small, materialise

SESSION = ["retailer_id", "category_id", "location_id", "run_id"]


def screened_pages(captures: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Adds blocked, outcome, the page's own store evidence, and what its session proved.

    A session's first page must prove the store, by any step; later pages only count what they show themselves. First pages are few, so they are written and, after
    a count, broadcast: pages with their markup are not shuffled.
    """
    place = dim_location.select("location_id", "store", "postal_code", "store_id")
    screened = classify_outcomes(classify_blocks(captures.join(place, "location_id")))
    flagged = verify_stores(screened, direct_only=F.col("page_number") > 1)
    pages = flagged.drop("store", "postal_code", "store_id", "store_context_verified").withColumnsRenamed(
        {"store_context_method": "direct_method", "page_number": "page", "status": "http_status"}
    )
    first = materialise(first_methods(pages, SESSION), "first-pages")
    carried = session_verified(pages, SESSION, first=broadcast_if_small(first))
    return carried.withColumnsRenamed(
        {"page": "page_number", "row_method": "store_context_method", "status": "session_status", "http_status": "status"}
    )


def usable_pages(captures: DataFrame, dim_location: DataFrame) -> DataFrame:
    screened = screened_pages(captures, dim_location)
    with_store = [r.retailer_id for r in R.RETAILERS if r.store_hints]
    proved = ~F.col("retailer_id").isin(*with_store) | F.col("verified")
    return screened.where(~F.col("blocked") & (F.col("outcome") == "OK") & proved)
