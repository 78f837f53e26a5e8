"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Every source is a queue of its documents in an order drawn by a hash. A document starts at the words that its source has
sent before it and finishes with its own; divided by the source's target these are virtual times. Passes over a source go
on as long as they start before the budget is spent. A copy that is under way when it is goes as two parcels, one that
finishes at that time and the rest. All parcels are sorted by virtual finish time over ranges, words are summed along
that order over all sources, and the mix is what comes before the total budget; the parcel that crosses it is cut. So a
source's words meet its target up to rounding, and all words together are the budget.

Targets share the budget (all words of the input) by weight; a target stops at ``most`` times its source's words, and the
excess is shared by weight again until none is above. The level of that sharing is found by rounds of one small aggregate
each over the table of sources, in whole numbers.

Sums along an order run over ranges of rows (``common.running``), so a source with a third of all rows, or rows that are
all alike, are dealt over many tasks.

Null sources are one source, the last in order; sources are weighed 1, 2, 3 and again by code points. Null texts have no
words; documents without words take nothing. Repeated rows are documents each: their order among each other changes
nothing but which of them is cut. Without words all targets are 0. An empty table gives an empty table. Columns besides
``doc_id``, ``source`` and ``text`` do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import WORD, ranged, running, unused
from anaquel.session import materialise

BEFORE = (Window.unboundedPreceding, -1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")]


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` plus ``place``, the position in the order of code points, nulls last.

    Rows are sorted over ranges; a range's offset is the count of the ranges before it.
    """
    order = F.col("source").asc_nulls_last()
    ordered = sources.repartitionByRange(order).sortWithinPartitions(order)
    numbered = materialise(ordered.withColumn("number", F.monotonically_increasing_id()), "ordered-sources")
    part, within = F.shiftright("number", 33), F.col("number") % (1 << 33)
    counts = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # A row per shuffle partition.
    offsets = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*BEFORE)), F.lit(0)).alias("offset"))
    joined = numbered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return joined.withColumn("place", F.col("offset") + within).drop("part", "number", "offset")


def with_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source``, ``source_size`` plus ``target`` and ``place``, its number among the sources."""
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int")).cast("long")
    rows = materialise(ranked_sources(sources).withColumn("weight", weight), "weighed-sources")
    top = F.col("source_size") * most
    # The level (words per weight) as a fraction; sources that it would lift above their top are closed, which
    # lifts the level for the others, until no more close.
    over, under = 0, 1
    while True:
        closed = top * under < F.col("weight") * over
        total, spent, open_weight = rows.agg(
            F.sum("source_size"), F.sum(F.when(closed, top).otherwise(0)), F.sum(F.when(closed, 0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        level = (int(total) - int(spent), int(open_weight))
        if level == (over, under):
            break
        over, under = level
    exact = lambda n: F.lit(n).cast("decimal(38,0)")
    lifted = F.col("weight") * F.lit(float(over)) / F.lit(float(under))
    capped = top.cast("decimal(38,0)") * exact(under) <= F.col("weight").cast("decimal(19,0)") * exact(over)
    return rows.withColumn("target", F.when(capped, top.cast("double")).otherwise(lifted)).select("source", "source_size", "target", "place")


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` plus an id per row, and that column's name. They are written together, as a second scan may be split
    otherwise."""
    [row] = unused(docs, "mix_row")
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents"), row


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 5, budget: int | None = None, row: str | None = None
) -> DataFrame:
    """The parcels of the mix, in order within ranges of virtual finish time: ``row`` (of the column that ``row`` names, or
    else an id given here), ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``repeat`` from 0, ``first`` and
    ``words`` (where in the copy the parcel begins, and how many words of it are sent), ``finish``. A document that is not
    sent has a row with no repeat and 0 words. ``budget`` is in words, at most and by default all of the targets.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    draw = F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in ("doc_id", "source", "text")])
    rows = materialise(docs.select(*measured(), draw.alias("draw"), number.alias("row")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(with_targets(materialise(sources, "sources"), weights, most), "targets")
    total = int(targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    budget = total if budget is None else min(budget, total)
    share = budget / total if total else 0.0
    # The words due to each source by the end: shares of the budget, rounded so that they add up to it.
    upto = running(ranged(targets, ["place"], "target-order"), None, {"upto": F.col("target") * share})
    ends, begins = F.floor(F.col("upto") + 0.5), F.floor(F.col("upto") - F.col("target") * share + 0.5)
    known = materialise(upto.select(F.col("source").alias("of"), "source_size", "target", "place", (ends - begins).cast("long").alias("due")), "due")
    joined = rows.join(known, rows["source"].eqNullSafe(F.col("of"))).drop("of")
    queues = running(ranged(joined, ["place", "draw", "doc_id", "size", "row"], "queues"), "place", {"sent": F.col("size")})
    first = F.col("sent") - F.col("size")
    # Pass after pass over the source, as long as the copy starts before the source's share of the budget is sent.
    passes = F.greatest(F.lit(0), F.ceil((F.col("due") - first) / F.col("source_size"))).cast("int")
    passes = F.when(F.col("size") > 0, passes).otherwise(0)
    copies = queues.withColumn("repeat", F.explode_outer(F.when(passes > 0, F.sequence(F.lit(0), passes - 1))))
    begin = first + F.col("repeat") * F.col("source_size")
    early = F.greatest(F.lit(0), F.least(F.col("size"), F.col("due") - begin)).cast("long")
    parcel = lambda at, words, late: F.struct(at.cast("long").alias("first"), words.cast("long").alias("words"), F.lit(late).alias("late"))
    parcels = F.filter(F.array(parcel(F.lit(0), early, False), parcel(early, F.col("size") - early, True)), lambda p: p["words"] > 0)
    cut = copies.withColumn("parcel", F.explode_outer(F.when(F.col("repeat").isNotNull(), parcels)))
    end = (begin + F.col("parcel.first") + F.col("parcel.words")) / F.col("target")
    finish = F.when(F.col("parcel.late"), F.greatest(end, F.lit(share))).otherwise(F.least(end, F.lit(share)))
    columns = ["row", "doc_id", "source", "size", "source_size", "target", "repeat"]
    timed = cut.select(*columns, "parcel.first", "parcel.late", F.coalesce("parcel.words", F.lit(0)).alias("held"), finish.alias("finish"))
    idle = timed.where("held = 0").withColumn("words", F.lit(0).cast("long"))
    order = ["finish", "late", "source_size", "first", "doc_id", "size", "repeat", "row"]
    sent = running(ranged(materialise(timed.where("held > 0"), "parcels"), order, "mix-order"), None, {"upto": F.col("held")})
    words = F.greatest(F.lit(0), F.least(F.col("held"), F.lit(budget) - (F.col("upto") - F.col("held")))).cast("long")
    whole = sent.withColumn("words", words).drop("_part", "_at", "upto").unionByName(idle)
    return whole.select(*columns, "first", "words", "finish")


def taken(mixed: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``."""
    return mixed.groupBy("row", "doc_id", "size", "source_size", "target").agg(F.sum("words").alias("taken")).drop("row")


def send(docs: DataFrame, mixed: DataFrame, row: str) -> DataFrame:
    """The documents as the mix sends them: a row per copy, the text of one that is cut ending behind its last word.
    ``docs`` and ``row`` are those of ``numbered`` that were mixed.
    """
    words, size = unused(docs, "words", "size")
    copies = mixed.where("words > 0").groupBy(F.col("row").alias(row), "repeat")
    rows = docs.join(copies.agg(F.sum("words").alias(words), F.any_value("size").alias(size)).drop("repeat"), row)
    # A cut text is split once more behind its last word; the rest is dropped.
    first = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.concat_ws("", F.slice(first, 1, F.col(words).cast("int")))
    text = F.when(F.col(words) < F.col(size), cut).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*[c for c in docs.columns if c != row])
