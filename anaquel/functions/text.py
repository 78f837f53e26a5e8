"""Text steps as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, plus the four separators that Java's class leaves out.
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
LINE_BREAK = r"\R|[\x1c-\x1e]"

# Accents that are folded (ñ is kept).
ACCENTED, PLAIN = "áéíóúü", "aeiouu"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; null without a match (Spark itself gives '')."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def all_matches(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def clean_text(c: Column) -> Column:
    return blank_to_null(F.trim(F.regexp_replace(c, SPACE_RUN, " ")))


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE_RUN, " "))


def fold_accents(c: Column) -> Column:
    """Lower case without accents, single spaces; null becomes ''."""
    return F.coalesce(_spaced(F.translate(F.lower(c), ACCENTED, PLAIN)), F.lit(""))


def percent_decode(c: Column) -> Column:
    """Decode %XX only: plus signs stay, stray percent signs stay."""
    stray = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(stray, F.lit("+"), F.lit("%2B"))), c)


def fold_decoded(c: Column) -> Column:
    return fold_accents(percent_decode(c))


def lower_spaced(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), SPACE_RUN, " ")


def clean_lines(c: Column) -> Column:
    """Non-empty cleaned lines of a text, in order."""
    cleaned = F.transform(F.split(c, LINE_BREAK), clean_text)
    return F.filter(cleaned, lambda x: x.isNotNull())


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(c, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def fallback_title(title: Column, text: Column) -> Column:
    """The given title, else the first line without a price that is longer than five characters.

    The text is cleaned to one line first, so a priced card has no fallback line.
    """
    line = F.filter(
        F.array(clean_text(text)), lambda x: x.isNotNull() & ~F.contains(x, F.lit("$")) & (F.length(x) > 5)
    )
    return F.coalesce(clean_text(title), F.get(line, F.lit(0)))


def once(value: Column) -> Column:
    """``value`` as the only element of a generator: the optimiser does not copy it into what reads it, so a dear
    expression is evaluated once a row. For one column of a select."""
    return F.explode(F.array(value))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
