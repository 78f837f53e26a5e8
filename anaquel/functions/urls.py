"""URL and SKU steps as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.text import blank_to_null, bound, clean_text, first_match


def url_path(url: Column) -> Column:
    bare = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(bare, r";[^/]*$", "")


def sku_from_url(url: Column, data_pid: Column | None = None) -> Column:
    """The page's product id when given, else the number in the URL path."""
    found = bound(url_path(url), lambda path: F.coalesce(*[first_match(path, p) for p in R.SKU_PATH_PATTERNS]))
    if data_pid is None:
        return found
    return F.when(F.coalesce(data_pid, F.lit("")) != "", clean_text(data_pid)).otherwise(found)


def sku_dash_html(url: Column, data_pid: Column | None = None) -> Column:
    found = first_match(url, R.SKU_DASH_HTML)
    return found if data_pid is None else F.coalesce(clean_text(data_pid), found)


def sku_p_path(url: Column) -> Column:
    """Digits after /p/ without leading zeros; an all-zero number is kept."""
    raw = first_match(url, R.SKU_P_PATH)
    return F.coalesce(blank_to_null(F.ltrim(raw, F.lit("0"))), raw)


def sku_html(html: Column) -> Column:
    """First of the known markup patterns with a non-blank value."""
    return F.coalesce(*[clean_text(first_match(html, p)) for p in R.SKU_HTML_PATTERNS])


def sku_detail(json_ld: Column, node_values: Column, body: Column, url: Column) -> Column:
    """Detail page: structured ids, then markup values, then labelled text, then the URL."""

    def whole_number(c: Column) -> Column:
        value = clean_text(c)
        return F.when(value.rlike(r"^\d{6,14}$"), value)

    structured = [whole_number(json_ld[k]) for k in R.SKU_JSON_LD_KEYS]
    from_nodes = F.filter(
        F.transform(node_values, lambda v: first_match(v, r"(?U)\b(\d{6,14})\b")), lambda v: v.isNotNull()
    )
    return F.coalesce(
        *structured, F.get(from_nodes, F.lit(0)), first_match(body, R.SKU_LABELLED), sku_p_path(url)
    )


def absolute_url(href: Column, base: Column | str) -> Column:
    """Resolve a link against its site's root address."""
    root = F.lit(base) if isinstance(base, str) else base
    origin = F.regexp_extract(root, r"^([^:]+://[^/?#]*)", 1)
    scheme = F.regexp_extract(root, r"^([^:]+:)", 1)
    link = blank_to_null(href)
    relative = F.regexp_replace(link, r"^(?:\.{1,2}/)+", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(origin, F.lit("/"), relative))
    )


def _form_encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _query_pairs(query: Column) -> Column:
    """Decoded (k, v) pairs of a query string in order."""

    def pair(part: Column) -> Column:
        key = F.regexp_extract(part, r"^([^=]*)", 1)
        value = F.regexp_replace(part, r"^[^=]*=?", "")
        return F.struct(
            F.coalesce(F.try_url_decode(key), key).alias("k"), F.coalesce(F.try_url_decode(value), value).alias("v")
        )

    return F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), pair)


def _grouped(pairs: Column, multi: bool) -> Column:
    """One entry per key at its first place: the last value, or all values when ``multi``."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))

    def entries(key: Column) -> Column:
        same = F.filter(pairs, lambda p: p["k"] == key)
        return same if multi else F.slice(same, -1, 1)

    return F.flatten(F.transform(keys, entries))


def page_url(url: Column, page: Column, parameter: str) -> Column:
    """Address of one page of a listing; other parameters are kept.

    ``page`` drops its parameter on page one, the other two leave the address as it is there;
    ``currentPage`` keeps repeated parameters.
    """
    multi = parameter == "currentPage"
    prefix = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    pairs = _grouped(_query_pairs(query), multi)
    number = F.struct(F.lit(parameter).alias("k"), page.cast("string").alias("v"))
    present = F.exists(pairs, lambda p: p["k"] == parameter)

    def first_or_other(p: Column) -> Column:
        return F.when(p["k"] == parameter, number).otherwise(p)

    replaced = F.transform(pairs, first_or_other)
    if multi:
        replaced = F.array_distinct(replaced)
    with_page = F.when(present, replaced).otherwise(F.concat(pairs, F.array(number)))
    without = F.filter(pairs, lambda p: p["k"] != parameter)

    def rebuild(entries: Column) -> Column:
        text = F.array_join(
            F.transform(entries, lambda p: F.concat(_form_encode(p["k"]), F.lit("="), _form_encode(p["v"]))), "&"
        )
        return F.concat(prefix, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")), fragment)

    first = rebuild(without) if parameter == "page" else url
    return F.when(page <= 1, first).otherwise(rebuild(with_page))


def browse_url(category_key: Column, start: Column, rows: Column) -> Column:
    """Range request of the search service (fixed parameters, in the order it expects)."""
    return F.concat(
        F.lit(R.BROWSE_ENDPOINT + "?origin=search_box&start="),
        start.cast("string"),
        F.lit("&rows="),
        rows.cast("string"),
        F.lit("&lang=es&scope=desktop&channel=tl&region=NACIONAL&browseField=categoryIds&browseValue="),
        _form_encode(category_key),
    )
