"""Brands from a table: each product meets only the brands that share a rare word with it.

A retailer's short list is one expression (``functions.brands``); a dictionary of any size is a join. Every word of a
brand that stands in a text is a word of the text, so one word of each brand is enough to find all places where it can
stand: the one that the fewest texts hold. Texts and brands meet on that word by an equi-join, and whether the brand
stands there as a whole is then tested exactly. So no pair is looked at that shares no word, and no pattern is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.session import materialise

_BETWEEN, _STARTS, _ENDS = "\u0001", "\u0002", "\u0003"


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"((?U)\w+)"), 1))


def whole_words(text: Column) -> Column:
    """Lower-cased text with a mark at every place outside of words: is it the start of one, its end, or neither?

    A marked brand is part of a marked text exactly where the brand stands in the text with no word character right
    before or behind it.
    """
    marked = F.regexp_replace(F.lower(text), r"(?U)(?<!\w)(?!\w)", _BETWEEN)
    return F.regexp_replace(F.regexp_replace(marked, r"(?U)(?<!\w)(?=\w)", _STARTS), r"(?U)(?<=\w)(?!\w)", _ENDS)


def match_brands(rows: DataFrame, brands: DataFrame, text: str = "product", by: tuple[str, ...] = (), out: str = "inferred") -> DataFrame:
    """``rows`` plus, as ``out``, the first brand (least ``priority``, then name) that stands in ``text`` as whole words.

    ``brands`` has ``brand`` and ``priority``, and the columns ``by``, which must be equal on both sides (such as the
    retailer; null meets nothing). Case does not matter. Brands without a word character, empty or null ones match nothing; a
    brand that is listed twice counts with its least priority. Rows of one text are judged once.
    """
    by = list(by)
    texts = rows.where(F.col(text).isNotNull()).select(*by, F.col(text).alias("_text")).distinct()
    texts = materialise(texts.withColumns({"_id": F.sha2("_text", 256), "_words": _words(F.col("_text"))}), "texts")
    words = texts.select(*by, "_id", F.explode("_words").alias("_word"))

    listed = brands.groupBy(*by, "brand").agg(F.min("priority").alias("priority"))
    parts = listed.withColumn("_word", F.explode(_words(F.col("brand"))))
    # How many texts hold a word counts only for words of brands.
    held = words.join(parts.select(*by, "_word").distinct(), [*by, "_word"], "left_semi")
    held = held.groupBy(*by, "_word").agg(F.count(F.lit(1)).alias("_held"))
    # A brand with a word that no text holds stands nowhere.
    known = parts.join(held, [*by, "_word"], "left").groupBy(*by, "brand", "priority").agg(
        F.min(F.coalesce("_held", F.lit(0))).alias("_least"), F.min_by("_word", F.struct(F.coalesce("_held", F.lit(0)), "_word")).alias("_word")
    )
    index = known.where(F.col("_least") > 0).select(*by, "_word", "brand", "priority", whole_words(F.col("brand")).alias("_marked"))

    met = words.join(index, [*by, "_word"]).drop("_word")
    stands = met.join(texts.drop("_words"), [*by, "_id"]).where(F.contains(whole_words(F.col("_text")), F.col("_marked")))
    first = stands.groupBy(*by, "_id", "_text").agg(F.min(F.struct("priority", "brand")).alias("_first"))
    found = first.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_text", F.col("_first.brand").alias("_brand"))
    same = F.col(text) == F.col("_text")
    for c in by:
        same = same & (F.col(c) == F.col(f"_by_{c}"))
    return rows.join(found, same, "left").select(*[F.col(c) for c in rows.columns if c != out], F.col("_brand").alias(out))
