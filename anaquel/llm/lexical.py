"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are dealt into strips. A strip's grid has a row per term and a column per document; a cell that is not
empty holds how often the document has the term, and stands for its impact. The grid is stored as a compressed
quadtree: each level has four bits per cell that say which of its quarters are not empty, and the greatest impact
in the cell. Columns are sorted by document length and rows by frequency, so that like impacts lie together.

An item looks its terms up in the strip. All their row paths descend at once over ranges of documents: the sum over
the terms of weight times the greatest impact of the quarter that the path enters bounds the score of each document
in the range. Ranges are taken best-first, up to ``BEAM`` of like bounds at a time, until the best one left is below
the item's ``k``-th score; at single documents the bound is the exact score. The k-th score is carried from strip to
strip of a task. Each task gives its best rows, and those are ranked over all tasks.

Every document is in the index and every term of it; nothing is sampled or cut. A strip is closed once it holds
``CELLS`` cells, so its memory is bounded; one document with more distinct terms is a strip of its own. Weights need
document frequencies of the items' terms, which are summed over the strips' dictionaries. Items are searched in
blocks of about ``BLOCK`` terms; only a block's terms are sent to the tasks.

Terms are maximal runs of ASCII letters and digits and of anything beyond ASCII; only A-Z is lower-cased. Null and
empty texts have no terms: they are in no strip and are never found. Documents without an id count in all statistics
and are not returned. Rows that share an id are documents each. Items without an id are left out; rows that share an
item id are one item with the terms of all. Equal scores rank by ascending ``doc_id``. Empty tables give an empty
table. Columns besides ``doc_id``, ``item_id`` and ``text`` do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import lean
from anaquel.session import materialise

#: A term: a run of anything but ASCII other than letters and digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms to themselves or lower case, all others to a space.
FOLDED = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: A strip is closed at this many cells.
CELLS = 1 << 20
#: Document ranges that one step of the descent takes.
BEAM = 256
#: Terms of items in one block.
BLOCK = 200_000
STRETCH = 1 << 20

STRIP = (
    "docs array<long>, missing array<int>, sizes array<long>, terms binary, held array<int>, side int, "
    "bits array<binary>, most array<binary>, times binary, often array<long>"
)


def stretches(text: str | None) -> Iterator[list[bytes]]:
    """A text's terms; those of a long text come stretch by stretch."""
    data, at = (text or "").encode("utf-8", "surrogatepass").translate(FOLDED), 0
    while at < len(data):
        end = data.find(b" ", at + STRETCH)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def terms_of(text: str | None) -> Counter:
    """How often a text holds each of its terms."""
    found = Counter()
    for terms in stretches(text):
        found.update(terms)
    return found


@dataclass(frozen=True)
class Totals:
    """Documents that have terms, and all their terms with repeats."""

    documents: int
    terms: int

    def damping(self, size: int) -> int:
        """What a document's length adds to the divisor of an impact."""
        return 8 * (10 + 90 * size * self.documents // self.terms)

    def weight(self, held: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * held + 1)))


def impact(times, damping):
    return 1_000_000_000 * times // (1000 * times + damping)


#: Impacts are below this.
MOST = 1_000_000


def rounded(impacts: np.ndarray) -> np.ndarray:
    """Impacts as bytes, rounded up, for the bounds."""
    return (-(-impacts * 255 // MOST)).astype(np.uint8)


def spread(x: np.ndarray) -> np.ndarray:
    """Every bit of numbers below 2^31 to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Strip:
    """Documents on their way into a quadtree."""

    def __init__(self, totals: Totals):
        self.totals = totals
        self.names: defaultdict[bytes, int] = defaultdict()
        self.names.default_factory = self.names.__len__  # a new term gets the next number
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.rows: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.cells = 0

    def add(self, doc: int | None, found: Counter) -> None:
        self.docs.append(doc)
        self.sizes.append(found.total())
        self.rows.append(np.fromiter(map(self.names.__getitem__, found), np.int64, len(found)))
        self.times.append(np.fromiter(found.values(), np.int64, len(found)))
        self.cells += len(found)

    def row(self) -> dict:
        """The strip as a row of the index."""
        by_size = np.argsort(np.array(self.sizes), kind="stable")
        column = np.empty(len(by_size), np.int64)
        column[by_size] = np.arange(len(by_size))
        counts = [len(r) for r in self.rows]
        rows, times = np.concatenate(self.rows), np.concatenate(self.times)
        held = np.bincount(rows, minlength=len(self.names))
        by_held = np.argsort(-held, kind="stable")
        place = np.empty(len(by_held), np.int64)
        place[by_held] = np.arange(len(by_held))
        names = list(self.names)
        damping = np.array([self.totals.damping(s) for s in self.sizes], np.int64)
        impacts = rounded(impact(times, np.repeat(damping, counts)))
        side = max(len(names) - 1, len(counts) - 1, 1).bit_length()
        code = (spread(place[rows]) << np.uint64(1)) | spread(np.repeat(column, counts))
        order = np.argsort(code)
        code, times, impacts = code[order], times[order], impacts[order]
        bits, most = [], []
        for _ in range(side):
            quarter, code = code & np.uint64(3), code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            code = code[first]
            bits.append(np.bitwise_or.reduceat(np.uint8(1) << quarter.astype(np.uint8), first).tobytes())
            impacts = np.maximum.reduceat(impacts, first)
            most.append(impacts.tobytes())
        docs = [self.docs[i] for i in by_size]
        return {
            "docs": [0 if d is None else d for d in docs],
            "missing": [i for i, d in enumerate(docs) if d is None],
            "sizes": [self.sizes[i] for i in by_size],
            "terms": b" ".join(names[i] for i in by_held),
            "held": held[by_held].astype(np.int32),
            "side": side,
            "bits": bits[::-1],
            "most": most[::-1],
            "times": np.minimum(times, 255).astype(np.uint8).tobytes(),
            "often": times[times >= 255],
        }


SIZES = np.array([bin(b).count("1") for b in range(16)], np.int64)
#: How many of a cell's quarters that are not empty come before each quarter.
BEFORE = np.array([[bin(b & ((1 << q) - 1)).count("1") for q in range(4)] for b in range(16)], np.int64)


class Tree:
    """A strip's quadtree, made ready for descending. Every level ends with a cell that is empty, at -1."""

    def __init__(self, row: dict, totals: Totals):
        self.side = row["side"]
        self.docs = np.array(row["docs"], np.int64)
        self.known = np.ones(len(self.docs), bool)
        self.known[np.array(row["missing"], np.int64)] = False
        self.damping = np.array([totals.damping(s) for s in row["sizes"]], np.int64)
        self.bits = [np.append(np.frombuffer(b, np.uint8), np.uint8(0)) for b in row["bits"]]
        self.first = [np.cumsum(SIZES[b]) - SIZES[b] for b in self.bits]
        self.most = [np.append(np.frombuffer(m, np.uint8), np.uint8(0)) for m in row["most"]]
        self.times = np.append(np.frombuffer(row["times"], np.uint8).astype(np.int64), 0)
        self.times[np.flatnonzero(self.times == 255)] = np.array(row["often"], np.int64)

    def children(self, level: int, cells: np.ndarray, row_bit: np.ndarray, column_bit: int) -> np.ndarray:
        """The cells that row paths enter from ``cells`` (ranges by terms) on one half of each range; -1 is empty."""
        bits, quarter = self.bits[level][cells], row_bit * 2 + column_bit
        there = (bits >> quarter) & 1
        return np.where(there == 1, self.first[level][cells] + BEFORE[bits, quarter], -1)

    def bounds(self, level: int, ranges: np.ndarray, cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The greatest score within each range, exact where ranges are single documents."""
        if level == self.side:
            times = self.times[cells]
            return (impact(times, self.damping[ranges][:, None]) * weights).sum(axis=1)
        return -(-(self.most[level][cells].astype(np.int64) * weights).sum(axis=1) * MOST // 255)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, held: list[tuple[int, int]]) -> None:
        """Push the strip's best documents onto ``held``, a heap of at most ``k`` pairs (score, -doc_id)."""
        start = np.zeros((1, len(rows)), np.int64)
        queue, turn = [(-int(self.bounds(0, np.zeros(1, np.int64), start, weights)[0]), 0, 0, np.zeros(1, np.int64), start)], 0
        while queue:
            bound, _, level, ranges, cells = heapq.heappop(queue)
            least = held[0][0] if len(held) == k else 1
            if -bound < least:
                break
            shift = self.side - 1 - level
            row_bit = ((rows >> shift) & 1).astype(np.uint8)
            halves = [self.children(level, cells, row_bit, half) for half in (0, 1)]
            ranges, cells = np.concatenate([ranges * 2, ranges * 2 + 1]), np.concatenate(halves)
            inside = (ranges << shift) < len(self.docs)
            ranges, cells = ranges[inside], cells[inside]
            bounds = self.bounds(level + 1, ranges, cells, weights)
            keep = np.flatnonzero(bounds >= least)
            keep = keep[np.argsort(-bounds[keep], kind="stable")]
            if level + 1 == self.side:
                for i in keep[self.known[ranges[keep]]]:
                    pair = (int(bounds[i]), -int(self.docs[ranges[i]]))
                    if len(held) < k:
                        heapq.heappush(held, pair)
                    elif pair > held[0]:
                        heapq.heapreplace(held, pair)
                    elif pair[0] < held[0][0]:
                        break
                continue
            for at in range(0, len(keep), BEAM):
                part = keep[at : at + BEAM]
                turn += 1
                heapq.heappush(queue, (-int(bounds[part[0]]), turn, level + 1, ranges[part], cells[part]))


def measure(docs: DataFrame) -> Totals:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [sum(map(len, stretches(text.as_py()))) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["size"])

    sizes = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "size long").where("size > 0")
    documents, terms = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return Totals(int(documents), int(terms))


def index(docs: DataFrame, totals: Totals) -> DataFrame:
    """The strips of all documents, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip = Strip(totals)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if found := terms_of(text.as_py()):
                    strip.add(doc.as_py(), found)
                if strip.cells >= CELLS:
                    yield as_batch(strip)
                    strip = Strip(totals)
        if strip.cells:
            yield as_batch(strip)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(lean(run), STRIP), "lexical-index")


KINDS = {
    "docs": pa.list_(pa.int64()), "missing": pa.list_(pa.int32()), "sizes": pa.list_(pa.int64()), "terms": pa.binary(),
    "held": pa.list_(pa.int32()), "side": pa.int32(), "bits": pa.list_(pa.binary()), "most": pa.list_(pa.binary()),
    "times": pa.binary(), "often": pa.list_(pa.int64()),
}


def as_batch(strip: Strip) -> pa.RecordBatch:
    row = strip.row()
    return pa.RecordBatch.from_arrays([pa.array([row[name]], kind) for name, kind in KINDS.items()], names=list(KINDS))


def frequencies(strips: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term is."""
    sent = strips.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for terms, held in zip(batch.column(0), batch.column(1)):
                for at, term in enumerate(terms.as_py().split(b" ")):
                    if term in sent.value:
                        total[term] += held[at].as_py()
        columns = [pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "held"])

    counted = strips.select("terms", "held").mapInArrow(lean(run), "term binary, held long").groupBy("term").agg(F.sum("held").alias("held"))
    return {bytes(r["term"]): r["held"] for r in counted.collect()}


def search(strips: DataFrame, totals: Totals, items: dict[int, set[bytes]], k: int) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of each item's ``k`` best documents; the items of one block."""
    held = frequencies(strips, set().union(*items.values()))
    weights = {t: w for t, n in held.items() if (w := totals.weight(n)) > 0}
    weighed = {i: {t: weights[t] for t in terms if t in weights} for i, terms in items.items()}
    sent = strips.sparkSession.sparkContext.broadcast((weighed, set(weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighed, wanted = sent.value
        best: dict[int, list[tuple[int, int]]] = {i: [] for i in weighed}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(c)[at].as_py() for c, n in enumerate(batch.schema.names)}
                rows = {t: r for r, t in enumerate(row["terms"].split(b" ")) if t in wanted}
                tree = Tree(row, totals)
                for item, terms in weighed.items():
                    met = [(rows[t], w) for t, w in terms.items() if t in rows]
                    if met:
                        tree.best(np.array([r for r, _ in met], np.int64), np.array([w for _, w in met], np.int64), k, best[item])
        flat = [(i, -doc, score) for i, pairs in best.items() for score, doc in pairs]
        columns = [pa.array([x[c] for x in flat], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    found = strips.mapInArrow(lean(run), "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Each item's ``k`` best documents with a score above 0."""
    totals = measure(docs)
    strips = index(docs, totals)
    pattern = F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TERM), F.lit(0))
    pairs = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.explode(pattern).alias("term")).distinct()
    pairs = materialise(pairs, "item-terms")
    blocks = max(1, -(-pairs.count() // BLOCK))
    parts = []
    for block in range(blocks):
        terms: dict[int, set[bytes]] = {}
        for r in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toLocalIterator():
            terms.setdefault(r["item_id"], set()).add(r["term"].encode("utf-8", "surrogatepass"))
        part = search(strips, totals, terms, k) if terms else None
        if part is not None:
            parts.append(part if blocks == 1 else materialise(part, "ranked"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
