"""Brand inference: a retailer's brand list becomes one expression, so no join is needed.

Lists are configuration of a few dozen names. A single alternation sorts out the rows that name
no brand at all; only the others walk the list.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from anaquel.functions.text import clean_lines, clean_text, title_case
from anaquel.registry import Retailer

_SPECIAL = re.compile(r"([\\.\[\]{}()*+?^$|&-])")


def _quoted(brand: str) -> str:
    return _SPECIAL.sub(r"\\\1", brand)


def brand_substring(text: Column, brands: Iterable[str]) -> Column:
    """First brand in list order contained anywhere in the text."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(F.contains(lowered, F.lit(b.lower())), F.lit(b)) for b in brands])


def brand_boundary(text: Column, brands: Iterable[str], aliases: dict[str, str] | None = None) -> Column:
    """First brand in list order that stands as a whole word."""
    names = list(brands)
    aliases = aliases or {}
    any_brand = r"(?iU)(?<!\w)(?:" + "|".join(_quoted(b) for b in names) + r")(?!\w)"
    walk = F.coalesce(
        *[
            F.when(text.rlike(rf"(?iU)(?<!\w){_quoted(b)}(?!\w)"), F.lit(aliases.get(b, b)))
            for b in names
        ]
    )
    return F.when(text.rlike(any_brand), walk)


def brand_longest(text: Column, brands: Iterable[str]) -> Column:
    """Whole-word match, longer names first."""
    return brand_boundary(text, sorted(brands, key=len, reverse=True))


def brand_headline(name: Column, text: Column) -> Column:
    """The upper-case line right above the product name."""
    lines = clean_lines(text)
    at = F.array_position(lines, name)
    above = F.when(at > 1, F.get(lines, (at - 2).cast("int")))
    fits = (F.length(above) <= 40) & (F.upper(above) == above) & above.rlike(r"\p{L}")
    return F.when(fits, F.when(F.length(above) > 4, title_case(above)).otherwise(above))


def infer_brand(retailer: Retailer, product: Column, text: Column | None = None) -> Column:
    """A retailer's own way from product name and card text to a brand."""
    if retailer.brand_mode == "substring":
        return brand_substring(product, retailer.brands)
    if retailer.brand_mode == "longest":
        return brand_longest(product, retailer.brands)
    text = F.lit(None).cast("string") if text is None else text
    if retailer.retailer_id == "farmacias-guadalajara":
        return F.coalesce(
            brand_headline(product, text), brand_boundary(clean_text(text), retailer.brands)
        )
    if retailer.retailer_id == "farmacias-san-pablo":
        blob = clean_text(F.concat_ws(" ", product, text))
    else:
        blob = F.coalesce(clean_text(text), clean_text(product))
    return brand_boundary(blob, retailer.brands, retailer.brand_aliases)
