"""One job for all price rules and one for all promotion rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.functions.money import RULES
from anaquel.functions.promotions import (
    badges,
    multibuy,
    percent_computed,
    percent_text,
    shelf_labels,
)
from anaquel.schema import MONEY


def resolve_prices(df: DataFrame, rule: str) -> DataFrame:
    """Adds price_current and price_regular by the named rule."""
    r = RULES[rule]
    parts = {f"_{k}": v for k, v in r.amounts(*[F.col(c) for c in r.reads]).items()}
    current, regular = r.choose({k[1:]: F.col(k) for k in parts})
    chosen = df.withColumns(parts).withColumns({"_current": current.cast(MONEY), "_regular": regular.cast(MONEY)})
    c, g = F.col("_current"), F.col("_regular")
    swapped = c > g
    if r.swap == "nonzero":
        swapped = swapped & (c != 0) & (g != 0)
    if r.swap == "never":
        prices = {"price_current": c, "price_regular": g}
    else:
        prices = {
            "price_current": F.when(swapped, g).otherwise(c),
            "price_regular": F.when(swapped, c).otherwise(g),
        }
    return chosen.withColumns(prices).drop(*parts, "_current", "_regular")


def extract_promotions(df: DataFrame, rule: str) -> DataFrame:
    """Adds promotion by the named rule, after prices are resolved."""
    now, usual = F.col("price_current"), F.col("price_regular")
    if rule == "badges":
        label = badges(F.col("promo_texts"))
    elif rule == "shelf_labels":
        label = shelf_labels(F.col("text"))
    elif rule == "multibuy":
        label = multibuy(F.col("text"), now, usual)
    elif rule == "percent_text":
        label = percent_text(F.col("text"), now, usual)
    elif rule == "computed":
        label = percent_computed(now, usual)
    elif rule == "computed_keep_zero":
        label = percent_computed(now, usual, keep_zero=True)
    else:
        raise ValueError(f"unknown promotion rule: {rule}")
    return df.withColumn("promotion", label)
