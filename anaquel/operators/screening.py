"""Screening of captures: block pages, HTTP outcome, proof of the configured store.

Page texts are folded into a column of their own, and the tests of a text bind it once: a filter on
their outcome may be pushed below the folding without repeating it per test.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions import classify as C

WITH_STORES = [r for r in R.RETAILERS if r.store_hints]


def _per_retailer(choose, retailers=R.RETAILERS) -> Column:
    return reduce(
        lambda case, r: case.when(F.col("retailer_id") == r.retailer_id, choose(r)),
        retailers[1:],
        F.when(F.col("retailer_id") == retailers[0].retailer_id, choose(retailers[0])),
    )


def _bound(text: str, test: Callable[[Column], Column]) -> Column:
    """A test over a text that is evaluated once, however often the test reads it."""
    return F.exists(F.array(text), test)


def classify_blocks(captures: DataFrame) -> DataFrame:
    """Adds ``blocked``, by each retailer's HTTP statuses, address and marker phrases."""
    title, body, html = F.col("title"), F.col("body_text"), F.col("html")
    screened = captures.withColumn("_screen", _per_retailer(lambda r: C.screen_text(r, title, body, html)))
    return screened.withColumn(
        "blocked",
        _per_retailer(lambda r: _bound("_screen", lambda t: C.is_blocked(r, F.col("status"), F.col("url"), t))),
    ).drop("_screen")


def classify_outcomes(captures: DataFrame) -> DataFrame:
    """Adds ``outcome``: OK, ERROR or NETWORK_UNAVAILABLE."""
    return captures.withColumn("outcome", C.classify_http(F.col("retailer_id"), F.col("status")))


# Where proof of a store is looked for, in order, and its tag; the first entry of a
# retailer reads the page itself, and the columns of later steps may be absent from a capture.
STEPS = {
    "walmart": [
        ("body_text", C.evidence_in_text, "category_text"),
        ("state_blob", C.evidence_in_state, "browser_state"),
        ("after_ui_text", C.evidence_in_text, "category_text_after_ui"),
        ("after_ui_state", C.evidence_in_state, "browser_state_after_ui"),
        ("detail_text", C.evidence_in_text, "product_detail_pickup_store"),
        ("detail_state", C.evidence_in_state, "product_detail_browser_state"),
    ],
    "chedraui": [
        ("body_text", C.evidence_in_text, "page_text"),
        ("state_blob", C.evidence_in_state, "browser_state"),
    ],
}


def _test(proof, retailer: R.Retailer, place: list[Column]) -> Callable[[Column], Column]:
    return lambda text: proof(retailer, text, *place)


# What a page shows by itself; the other steps are taken once, to establish a session.
DIRECT = ("body_text", "state_blob")


def verify_stores(captures: DataFrame, direct_only: Column | None = None) -> DataFrame:
    """Adds the verification flag and its method: the tag of the first proof that holds.

    ``captures`` carries the configured store, postal code and store id. Retailers without stores
    are never verified. Where ``direct_only`` holds, only what the page itself shows is proof.
    """
    indirect = F.lit(True) if direct_only is None else ~F.coalesce(direct_only, F.lit(False))
    sources = [c for c in dict.fromkeys(s for steps in STEPS.values() for s, _, _ in steps) if c in captures.columns]
    folded = captures.withColumns(
        {f"_{c}": _per_retailer(lambda r, c=c: C.fold_for(r, F.col(c)), WITH_STORES) for c in sources}
    )
    place = [F.col(c) for c in ("store", "postal_code", "store_id")]

    def method(r) -> Column:
        found = [
            F.when((F.lit(source in DIRECT) | indirect) & _bound(f"_{source}", _test(proof, r, place)), F.lit(tag))
            for source, proof, tag in STEPS[r.retailer_id]
            if source in sources
        ]
        return F.coalesce(*found)

    tagged = folded.withColumn("store_context_method", _per_retailer(method, WITH_STORES))
    return tagged.withColumn("store_context_verified", F.col("store_context_method").isNotNull()).drop(
        *[f"_{c}" for c in sources]
    )
