"""Sharding by histogram sort, with DataFrame operations only: shards of near equal bytes.

Documents are ordered by a hash of the text, then a hash of the id, so equal texts stand together. The
splitters between shards are found by rounds: probes are set between the bounds of each splitter, one
aggregate counts the exact bytes below every probe over all partitions, and the bounds close in until a
probe is within ``tolerance`` of its goal. If the bounds meet at one text whose copies are more than that,
the search goes on among the ids of that text; groups within the tolerance stay whole. Each round sends a
few hundred sums to the driver, whatever the size of the table. Then whole rows move once, to their shard (``exchange``),
and are written there in the order of their keys; sizes, checksums and slots are read from what was written.

The law is ``bytes``. Slots count the rows of a shard from 0, in that order: sums over ranges of rows (``common.running``).

Null texts count as empty and equal to them. Null ids and repeated rows are placed like all others; rows that
agree in text and id stay together, whatever their number, but are dealt over many tasks. An empty table gives an empty
table. Columns besides ``doc_id`` and ``text`` do not matter for the placing, may have any names, and go along in
``exchange``.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import last_at_most, running, unused
from anaquel.session import materialise, work_dir

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
PROBES = 16

Splitter = tuple[int, int]


def text_of() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def keys() -> tuple[Column, Column]:
    return F.xxhash64(text_of()), F.xxhash64(F.lit(1), F.col("doc_id").cast("long"))


def below(rows: DataFrame, key: str, probes: list[int]) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Exact bytes of the rows whose key is below each of the sorted probes, and the least and largest key of the
    rows between a probe and the next, by the probe's index (-1: below all)."""
    binned = rows.groupBy(last_at_most(probes, F.col(key)).alias("bin")).agg(
        F.sum("size").alias("held"), F.min(key).alias("least"), F.max(key).alias("most")
    )
    found = binned.collect()  # at most one row per probe and one more
    held = {r["bin"]: r["held"] for r in found}
    sums, total = [], 0
    for k in range(len(probes)):
        total += held.get(k - 1, 0)
        sums.append(total)
    return sums, {r["bin"]: (r["least"], r["most"]) for r in found}


def search(rows: DataFrame, key: str, goals: list[int], total: int, tolerance: float) -> list[tuple[int, int, int | None]]:
    """For each goal the boundary nearest to it: its key, the bytes below, and the size of the group
    that starts there if the goal lies deeper in it than the tolerance."""
    bounds = [(LOWEST, 0, HIGHEST + 1, total) for _ in goals]
    found: list[tuple[int, int, int | None] | None] = [None] * len(goals)
    while any(f is None for f in found):
        wanted: set[int] = set()
        for (low, _, high, _), done in zip(bounds, found):
            if done is None:
                # The first round spreads all goals' probes over the whole range.
                n = PROBES * (len(goals) if (low, high) == (LOWEST, HIGHEST + 1) else 1)
                wanted |= {low + (high - low) * i // (n + 1) for i in range(1, n + 1)} - {low, high, HIGHEST + 1}
        probes = sorted(wanted)
        sums, spans = below(rows, key, probes) if probes else ([], {})
        known = list(zip(probes, sums))
        for k, goal in enumerate(goals):
            if found[k] is not None:
                continue
            low, low_sum, high, high_sum = bounds[k]
            for probe, held in known:
                if low < probe < high:
                    low, low_sum, high, high_sum = (probe, held, high, high_sum) if held <= goal else (low, low_sum, probe, held)
                    if held > goal:
                        break
            # The bounds close in on the keys that are there, so a lone heavy text is found at once.
            if span := spans.get(bisect_right(probes, low) - 1):
                low, high = max(low, span[0]), min(high, span[1] + 1)
            bounds[k] = (low, low_sum, high, high_sum)
            near = min([(low, low_sum), (high, high_sum)], key=lambda b: abs(b[1] - goal))
            if abs(near[1] - goal) <= tolerance or low_sum == high_sum:
                found[k] = (min(near[0], HIGHEST), near[1], None)
            elif high - low == 1:
                found[k] = (low, low_sum, high_sum - low_sum)
    return found  # type: ignore[return-value]


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.01) -> list[Splitter]:
    """Keys at which shards 1, 2, ... begin; ``rows`` has ``text_key``, ``id_key``, ``size``; ``tolerance`` is a
    share of a shard's bytes."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    goals = [total * k // shards for k in range(1, shards)]
    allowed = tolerance * total / shards
    first = search(rows, "text_key", goals, total, allowed)
    out: dict[int, Splitter] = {k: (key, LOWEST) for k, (key, _, group) in enumerate(first) if group is None}
    for text in {key for key, _, group in first if group is not None}:
        inside = [k for k, f in enumerate(first) if f[2] is not None and f[0] == text]
        copies = rows.where(F.col("text_key") == text)
        base, size = first[inside[0]][1], first[inside[0]][2]
        for k, (key, held, group) in zip(inside, search(copies, "id_key", [goals[k] - base for k in inside], size, allowed)):
            goal = goals[k] - base
            # Rows of one key stay together, on the nearer side.
            past = group is not None and goal - held > held + group - goal
            out[k] = (text, min(key + 1, HIGHEST) if past else key)
    return sorted(out.values())


def shard_of(found: list[Splitter], text_key: Column, id_key: Column) -> Column:
    """The number of splitters at or below a row."""
    passed = [((text_key > F.lit(t).cast("long")) | ((text_key == F.lit(t).cast("long")) & (id_key >= F.lit(i).cast("long")))).cast("int") for t, i in found]
    return sum(passed, F.lit(0)).cast("int")


def assign(docs: DataFrame, shards: int = 16, tolerance: float = 0.01) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of each document, as exchanged."""
    text_key, id_key = keys()
    size = (F.octet_length(text_of()) + 1).cast("long")
    rows = materialise(docs.select(text_key.alias("text_key"), id_key.alias("id_key"), size.alias("size")), "shard-rows")
    moved, shard, at = exchange(docs, splitters(rows, shards, tolerance), work_dir(docs.sparkSession, "shards"))
    placed = moved.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text_of()).alias("text_crc32"),
        F.col(shard).alias("shard"), F.col(at).alias("_at"), F.shiftright(at, 33).alias("_part"),
    )
    return running(placed, "shard", {"slot": F.lit(1).cast("long")}).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def exchange(docs: DataFrame, found: list[Splitter], path: str) -> tuple[DataFrame, str, str]:
    """Move whole rows once, and write each shard as a folder of files in key order. Gives the written rows, and the names
    of two columns beside those of ``docs``: the shard, and the row's place in the order of all (with gaps)."""
    shard, at, text, key, tie = unused(docs, "shard", "place", "text_key", "id_key", "tie")
    text_key, id_key = keys()
    keyed = docs.withColumns({text: text_key, key: id_key, tie: F.monotonically_increasing_id()})
    keyed = keyed.withColumn(shard, shard_of(found, F.col(text), F.col(key)))
    order = [shard, text, key, tie]
    moved = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop(text, key, tie)
    moved = moved.withColumn(at, F.monotonically_increasing_id())
    moved.write.partitionBy(shard).parquet(path)
    return docs.sparkSession.read.schema(moved.schema).parquet(path), shard, at
