"""Money: tokens, parsing and the retailers' rules for current and regular price."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.text import all_matches, clean_text, first_match
from anaquel.schema import MONEY


def parse_money(c: Column) -> Column:
    """First number of a text, thousands commas dropped, a third decimal cut off."""
    # Without a match this is '', which is no number either; a test for it would run the pattern twice.
    return F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), R.MONEY_SIGNED, 0).try_cast(MONEY)


def to_price(c: Column) -> Column:
    """A JSON number or numeric text to two decimals; anything else is null."""
    return c.try_cast("double").try_cast(MONEY)


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def dollar_tokens(text: Column) -> Column:
    return _present(F.transform(all_matches(F.coalesce(text, F.lit("")), R.MONEY_DOLLAR), parse_money))


def distinct_dollar_tokens(texts: Column) -> Column:
    """Distinct amounts over an array of texts, in order of first sight."""
    present = F.filter(texts, lambda t: t.isNotNull())
    return F.array_distinct(F.flatten(F.transform(present, dollar_tokens)))


def positive_amounts(text: Column) -> Column:
    found = F.transform(all_matches(F.coalesce(text, F.lit("")), R.MONEY_AMOUNT), parse_money)
    return F.filter(found, lambda v: v > 0)


def mxn_amounts(text: Column) -> Column:
    return _present(F.transform(all_matches(F.coalesce(text, F.lit("")), R.MONEY_MXN), parse_money))


def mxn_amount(text: Column) -> Column:
    return parse_money(first_match(text, R.MONEY_MXN))


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _second(values: Column) -> Column:
    return F.get(values, F.lit(1))


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


Parts = dict[str, Column]


@dataclass(frozen=True)
class PriceRule:
    """How a card's columns become current and regular price.

    ``amounts`` reads the texts once into a few columns, ``choose`` picks the two prices from
    those. Keeping the steps apart lets Spark evaluate each text pattern once per row. ``swap``
    says when a current price above the regular one changes places with it.
    """

    reads: tuple[str, ...]
    amounts: Callable[..., Parts]
    choose: Callable[[Parts], tuple[Column, Column]]
    swap: str = "always"  # or "nonzero" (a zero stays where it is) or "never"


def _listed(price_texts: Column) -> Parts:
    return {"values": distinct_dollar_tokens(price_texts)}


def _labelled(text: Column) -> Parts:
    return {
        "now": parse_money(first_match(text, R.PRICE_NOW)),
        "before": parse_money(first_match(text, R.PRICE_BEFORE)),
        "values": dollar_tokens(text),
    }


def _choose_labelled(p: Parts) -> tuple[Column, Column]:
    unlabelled = F.coalesce(F.nullif(p["before"], F.lit(0).cast(MONEY)), _second(p["values"]), _first(p["values"]))
    regular = F.when(p["now"].isNull(), unlabelled).otherwise(F.coalesce(p["before"], p["now"]))
    return F.coalesce(p["now"], _first(p["values"])), regular


def _selected(selling: Column, regular: Column, price_texts: Column, text: Column) -> Parts:
    texts = F.when(F.size(price_texts) > 0, price_texts).otherwise(F.array(text))
    return {
        "selling": parse_money(selling),
        "listed": parse_money(regular),
        "values": distinct_dollar_tokens(texts),
    }


def _choose_selected(p: Parts) -> tuple[Column, Column]:
    current = F.coalesce(p["selling"], _first(p["values"]))
    return current, F.coalesce(p["listed"], _second(p["values"]), current)


def _card(final_text: Column, old_text: Column, text: Column) -> Parts:
    return {
        "final": mxn_amount(final_text),
        "old": mxn_amount(old_text),
        "values": mxn_amounts(clean_text(text)),
    }


def _choose_card(p: Parts) -> tuple[Column, Column]:
    current = F.coalesce(p["final"], _last(p["values"]))
    return current, F.coalesce(p["old"], F.array_max(p["values"]), current)


def _detail(price_text: Column, old_texts: Column, offer_price: Column) -> Parts:
    priced = F.filter(F.coalesce(old_texts, F.array().cast("array<string>")), lambda t: F.contains(t, F.lit("$")))
    return {
        "main": positive_amounts(clean_text(price_text)),
        "old": F.flatten(F.transform(priced, positive_amounts)),
        "offer": to_price(offer_price),
    }


def _choose_detail(p: Parts) -> tuple[Column, Column]:
    current = _first(p["main"])
    largest = F.array_max(F.concat(p["main"], p["old"]))
    return F.coalesce(current, p["offer"]), F.when(current.isNotNull(), largest).otherwise(p["offer"])


def _previous(current_price: Column, previous_price: Column) -> Parts:
    return {"now": to_price(current_price), "before": to_price(previous_price)}


RULES = {
    # First distinct amount is current, second is regular.
    "listed": PriceRule(
        ("price_texts",),
        _listed,
        lambda p: (_first(p["values"]), F.coalesce(_second(p["values"]), _first(p["values"]))),
        swap="nonzero",
    ),
    # Amounts behind their labels, else the first two amounts.
    "labelled": PriceRule(("text",), _labelled, _choose_labelled, swap="never"),
    # Dedicated price nodes first, then the distinct amounts of price nodes or of the whole card.
    "selected": PriceRule(
        ("selling", "regular", "price_texts", "text"), _selected, _choose_selected, swap="nonzero"
    ),
    # Regular stands before current.
    "first_last": PriceRule(
        ("text",), lambda t: {"values": positive_amounts(t)}, lambda p: (_last(p["values"]), _first(p["values"]))
    ),
    # Named price texts; current falls back to the last amount, regular to the largest.
    "card": PriceRule(("final_text", "old_text", "text"), _card, _choose_card),
    # Lowest and highest amount.
    "min_max": PriceRule(
        ("text",),
        lambda t: {"values": positive_amounts(t)},
        lambda p: (F.array_min(p["values"]), F.array_max(p["values"])),
        swap="never",
    ),
    # Main price node with the largest old price; without the node, the structured offer.
    "detail": PriceRule(("price_text", "old_texts", "offer_price"), _detail, _choose_detail, swap="never"),
    # Regular is the previous price, or current where that is absent or lower.
    "previous": PriceRule(
        ("current_price", "previous_price"),
        _previous,
        lambda p: (p["now"], F.when(p["before"] >= p["now"], p["before"]).otherwise(p["now"])),
        swap="never",
    ),
}


def evidence_json(**values: Column) -> Column:
    """Compact JSON of the raw values, nulls kept."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})
