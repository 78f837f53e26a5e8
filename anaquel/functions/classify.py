"""Classification of captures and runs, and store evidence, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.text import ACCENTED, PLAIN, first_match, fold_accents, fold_decoded, lower_spaced
from anaquel.registry import Retailer

_FOLD = str.maketrans(ACCENTED, PLAIN)


def _any_marker(text: Column, markers: list[str]) -> Column:
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(text, F.lit(marker))
    return hit


def screen_text(retailer: Retailer, title: Column, body: Column, html: Column) -> Column:
    """The text in which a retailer's block markers are looked for, folded its way."""
    empty = F.lit("")
    if retailer.block_text == "folded_body":
        text = fold_accents(body)
    elif retailer.block_text == "decoded_body":
        text = fold_decoded(body)
    elif retailer.block_text == "spaced_html":
        text = lower_spaced(html)
    elif retailer.block_text == "title_and_body":
        text = F.lower(F.concat(F.coalesce(title, empty), F.lit("\n"), F.coalesce(body, empty)))
    else:
        text = F.lower(body)
    return F.coalesce(text, empty)


def is_blocked(retailer: Retailer, status: Column, url: Column, screen: Column) -> Column:
    """Does a capture with this screen text show a block page, by this retailer's signs?"""
    markers = [m.lower() for m in retailer.block_markers]
    if retailer.block_text in ("folded_body", "decoded_body"):
        markers = [m.translate(_FOLD) for m in markers]
    blocked = _any_marker(screen, markers)
    if retailer.block_url:
        blocked = F.contains(F.lower(F.coalesce(url, F.lit(""))), F.lit(retailer.block_url)) | blocked
    if retailer.block_statuses:
        blocked = F.coalesce(status, F.lit(0)).isin(*retailer.block_statuses) | blocked
    return blocked


def classify_http(retailer_id: Column, status: Column) -> Column:
    """OK, HTTP error, or no answer from the network."""
    offline = (retailer_id == "farmacias-del-ahorro") & ((status < 200) | (status >= 300))
    return (
        F.when(status.isNull() | offline, F.lit("NETWORK_UNAVAILABLE"))
        .when(status >= 400, F.lit("ERROR"))
        .otherwise(F.lit("OK"))
    )


def classify_case(exit_code: Column, log_text: Column) -> Column:
    """Status of a run from its exit code and log; a clean exit wins, then the log can override the code."""
    text = F.lower(F.coalesce(log_text, F.lit("")))

    def says(word: str) -> Column:
        return F.contains(text, F.lit(word))

    return (
        F.when(exit_code == 0, F.lit("SUCCESS"))
        .when((exit_code == 2) | says("blocked:"), F.lit("BLOCKED"))
        .when((exit_code == 4) | says("store_context_error"), F.lit("STORE_CONTEXT_ERROR"))
        .when((exit_code == 5) | says("network_unavailable:"), F.lit("NETWORK_UNAVAILABLE"))
        .when(exit_code == 3, F.lit("EMPTY"))
        .otherwise(F.lit("ERROR"))
    )


def reported_products(log_text: Column) -> Column:
    return F.coalesce(first_match(log_text, R.REPORTED_PRODUCTS).try_cast("int"), F.lit(0))


MARK = "\x1f"  # folded text holds none: it counts as white space


def _near(text: Column, name: Column, hints: tuple[str, ...], reach: int) -> Column:
    """A hint and the name within ``reach`` characters of each other, in either order.

    The name differs from row to row, so its places are marked by plain replacement and the pattern stays constant. Marks
    stand before the name where a hint precedes it, after it where one follows; the nearest mark decides. A mark may lie
    inside a hint that another place of the name cuts into. Places of a name that overlap each other are taken from the left.
    """
    words = "|".join(f"{MARK}?".join(hint) for hint in hints)
    before = F.replace(text, name, F.concat(F.lit(MARK), name)).rlike(f"(?s)(?:{words})[^{MARK}]{{0,{reach}}}{MARK}")
    after = F.replace(text, name, F.concat(name, F.lit(MARK))).rlike(f"(?s){MARK}[^{MARK}]{{0,{reach}}}(?:{words})")
    return before | after


def _holds(text: Column, value: Column) -> Column:
    return (value != "") & F.contains(text, value)


def fold_for(retailer: Retailer, text: Column) -> Column:
    """The folding under which a retailer's store names are compared."""
    return fold_accents(text) if retailer.store_keyword else fold_decoded(text)


def evidence_in_text(retailer: Retailer, page: Column, store: Column, postal: Column, store_id: Column) -> Column:
    """Does the folded page text prove the configured store?"""
    store, postal, store_id = (fold_for(retailer, c) for c in (store, postal, store_id))
    if retailer.store_keyword:
        words = "|".join(retailer.store_hints)
        keyword = retailer.store_keyword
        near = page.rlike(f"(?s)(?:{words}).{{0,140}}{keyword}|{keyword}.{{0,140}}(?:{words})")
        detail = _holds(page, store_id) | _holds(page, postal) | F.contains(page, F.lit(retailer.store_full_name))
        return F.contains(page, F.lit(keyword)) & (detail | near)
    proof = _holds(page, postal) | _holds(page, store_id) | _near(page, store, retailer.store_hints, 100)
    return _holds(page, store) & proof


def evidence_in_state(retailer: Retailer, state: Column, store: Column, postal: Column, store_id: Column) -> Column:
    """At least two signs of the store in folded session state."""
    store, postal, store_id = (fold_for(retailer, c) for c in (store, postal, store_id))
    if retailer.store_keyword:
        named = F.contains(state, F.lit(retailer.store_keyword))
        signs = [named, _holds(state, store_id), _holds(state, postal), F.contains(state, F.lit("selecto"))]
    else:
        named = F.lit(True)
        signs = [_holds(state, v) for v in (store, postal, store_id)]
    hits = sum((s.cast("int") for s in signs), F.lit(0))
    return named & (hits >= 2)
