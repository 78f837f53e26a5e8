"""Near-duplicates by MinHash with tensored banding, every link confirmed on the full sets.

A document's set holds the hashes of its distinct word shingles. Banding with b tables of r values each would
take b * r minhashes. Here two small collections of sketches are made, ``SKETCHES`` each of ``ROWS`` minhashes,
and a table is keyed by a pair of sketches, one from either: SKETCHES^2 tables of 2 * ROWS values from
2 * SKETCHES * ROWS minhashes. Two sets of similarity s meet in some table with chance
(1 - (1 - s^ROWS)^SKETCHES)^2: 99.9 % at 0.85, 99.99 % at 0.9.

Large groups never become all their pairs:

* Equal sets are one class from the start; only classes are compared.
* In each table's bucket a member, drawn by a hash, is the centre, and the others are compared with it.
  As every table draws anew, a group of near copies meets many centres.
* What these links leave in different components of a bucket is compared across components: members outside
  the bucket's largest component with members of other components. In small buckets all such pairs are. In
  others a pair first has to pass an exact bound: with all shingles in one order, rarest first, two similar sets
  share one of their first few, and the places of the first that they share bound the whole overlap. So a
  member with many words of its own is settled without comparing it.

Then all pairs that share a bucket are in one component, or were compared on their full sets, or cannot be
similar.

Components come from large-star and small-star rounds over tables in the shared folder; nothing is collected.

With ``exact`` no link is left to chance: after that, every class is compared with classes of other components that hold
one of its rarest shingles. Similar sets share one, so nothing is missed; it costs a shuffle of all shingles.

Null texts and texts without words have empty sets, are linked with nothing and kept. Rows without an id are
linked with nothing, have no component and are kept. Rows of one id and several texts go each with its own
text: ids name documents in the result only, inside a row is known by its id and two hashes of its text. Shingles
are compared by 64-bit hashes. An empty table gives an empty table.

``drop_near_copies`` keeps one row of each group, the one with the least id (then text hash). Rows that agree in id and
text are one document there, and one of them stays; rows without an id or without words all stay. Columns may have any
names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import Memo, lean, unused
from anaquel.session import materialise, unsent

ROWS = 2
SKETCHES = 6
#: From this size on, a bucket's pairs are bounded by their rarest shingles before they are compared.
LARGE = 16
#: Ids up to this number are sent to all tasks (about 130 bytes each on the driver) instead of shuffling the texts.
SENT_IDS = 400_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest, 100_000)


def hashing(run: Callable) -> Callable:
    """A lean task that hashes words: what the worker remembers of them ends with it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            word_hashes.cache_clear()

    return lean(task)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; A-Z is lower-cased, words are cut at ASCII white space."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    count = len(one) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = mixed(total + one[k : k + count])
    return np.unique(total)


@lru_cache(maxsize=4)
def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return tuple(rng.integers(0, 1 << 63, count, np.uint64)[:, None] * np.uint64(2) + np.uint64(1) for _ in "ab")


def sketch(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` sketches of ROWS minhashes each."""
    a, b = permutations(count * ROWS)
    least = np.full(count * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 14):
        np.minimum(least, mixed(hashes[at : at + (1 << 14)] * a + b).min(axis=1), out=least)
    rows = least.reshape(count, ROWS)
    total = np.zeros(count, np.uint64)
    for k in range(ROWS):
        total = mixed(total + rows[:, k])
    return total.view(np.int64)


#: What tells rows of one id apart.
ROW = ["doc_id", "t1", "t2"]


def row_key(docs: DataFrame) -> list:
    """The columns of ROW: a row's id and two hashes of its text."""
    return [F.col("doc_id").cast("long"), F.xxhash64("text"), F.xxhash64(F.lit(1), "text")]


def sketched(docs: DataFrame, words: int, sketches: int) -> DataFrame:
    """ROW, the size of the set, its digest (null if empty) and its sketches."""
    names = [*ROW, "n", "digest", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sizes, digests, rows = [], [], []
                for text in part.column(3):
                    hashes = shingles(text.as_py(), words)
                    sizes.append(len(hashes))
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                    rows.append(sketch(hashes, 2 * sketches).tolist() if len(hashes) else None)
                made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(rows, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], names=names)

    rows = docs.select(*[c.alias(n) for n, c in zip(ROW, row_key(docs))], "text")
    return rows.mapInArrow(hashing(run), "doc_id long, t1 long, t2 long, n long, digest binary, sketch array<long>")


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Texts of the classes ``nodes`` (``node`` and the ROW that stands for it), written once."""
    few = nodes.count() <= SENT_IDS
    rows = docs.where("doc_id is not null").select(*[c.alias(n) for n, c in zip(ROW, row_key(docs))], "text")
    found = rows.join(F.broadcast(nodes) if few else unsent(nodes), ROW).select("node", "text")
    return materialise(found.distinct(), "texts")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(unsent(classes.select("node", *ROW)), "node")
    texts = texts_of(docs, materialise(nodes, "pair-nodes"))
    with_a = pairs.join(unsent(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))), "a")
    both = with_a.join(unsent(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(lambda text: shingles(text, words), 512)
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                left, right = known[x.as_py()], known[y.as_py()]
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * common >= percent * (len(left) + len(right) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return materialise(both.select("a", "b", "text_a", "text_b").mapInArrow(hashing(run), "a long, b long"), "links")


def rarest_shingles(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """``nodes`` as for ``texts_of``; ``node``, ``n``, ``shingle``, ``place`` (from 1) for the first shingles of each node, rarest among all nodes
    first; so many that similar sets share one. Those that no other node holds are left out, but take places.
    """
    texts = texts_of(docs, nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0), batch.column(1)):
                hashes = shingles(text.as_py(), words)
                for at in range(0, len(hashes), 1 << 16):
                    part = hashes[at : at + (1 << 16)].view(np.int64)
                    columns = [pa.array(np.full(len(part), node.as_py())), pa.array(np.full(len(part), len(hashes))), pa.array(part)]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "shingle"])

    rows = materialise(texts.mapInArrow(hashing(run), "node long, n long, shingle long"), "node-shingles")
    holders = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = rows.join(unsent(holders), "shingle")
    order = Window.partitionBy("node").orderBy("holders", "shingle")
    placed = shared.withColumn("after", F.count(F.lit(1)).over(Window.partitionBy("node"))).withColumn("number", F.row_number().over(order))
    place = F.col("n") - F.col("after") + F.col("number")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return placed.select("node", "n", "shingle", place.alias("place")).where(F.col("place") <= first)


def stars(edges: DataFrame) -> DataFrame:
    """Connected components: ``node`` and ``component``, its least node; only nodes that have links."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(unsent(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # Every node's edges now lead to lesser nodes only.
        large = materialise(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(unsent(least), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialise(small.distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def grouped(docs: DataFrame, words: int, percent: int, sketches: int, exact: bool) -> DataFrame:
    """A row per document: ROW, ``n``, and ``first``, the ROW of its component's first document (null without words)."""
    rows = materialise(sketched(docs, words, sketches), "sketches")
    # The digest stands for the set, so any row's size and sketches are the class's.
    held = rows.where("doc_id is not null and digest is not null")
    first = F.min(F.struct(*ROW)).alias("first")
    classes = held.groupBy("digest").agg(first, F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    classes = materialise(classes.select("digest", "first.*", "n", "sketch", F.monotonically_increasing_id().alias("node")), "classes")
    tables = [F.xxhash64(F.lit(i * sketches + j), F.get("sketch", F.lit(i)), F.get("sketch", F.lit(sketches + j))) for i in range(sketches) for j in range(sketches)]
    keys = classes.select("node", "n", F.explode(F.array(*tables)).alias("key"))
    drawn = F.min(F.struct(F.xxhash64("key", "node").alias("draw"), F.col("node").alias("centre"), F.col("n").alias("centre_n")))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), drawn.alias("drawn")).where("members > 1")
    met = keys.join(unsent(buckets.select("key", "members", "drawn.centre", "drawn.centre_n")), "key")
    met = materialise(met, "buckets")
    possible = F.least("n", "centre_n") * 100 >= F.greatest("n", "centre_n") * percent
    pairs = met.where((F.col("node") != F.col("centre")) & possible)
    pairs = materialise(pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "pairs")
    links = confirmed(docs, classes, pairs, words, percent)
    parts = materialise(stars(links), "components")

    split = met.select("key", "node", "n", "members").join(unsent(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = materialise(split, "split-buckets")
    sizes = split.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    main = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("held", "component")).alias("main")).where("parts > 1")
    split = materialise(split.join(unsent(main.select("key", "main")), "key"), "mixed-buckets")
    outside = F.col("component") != F.col("main")
    similar = lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent
    differ = F.col("component") != F.col("l_component")

    small = split.where(F.col("members") < LARGE)
    left = small.where(outside).select("key", *[F.col(c).alias(f"l_{c}") for c in ("node", "n", "component")])
    once = ~outside | (F.col("l_node") < F.col("node"))
    across = left.join(unsent(small), "key").where(differ & once & similar("n", "l_n")).select("node", "l_node")

    if exact:
        large = classes.select("node").join(unsent(parts), "node", "left").select("node", F.coalesce("component", "node").alias("component"), F.lit(True).alias("outside"))
    else:
        large = split.where(F.col("members") >= LARGE).groupBy("node", "component").agg(F.bool_or(outside).alias("outside"))
    large = materialise(large, "large-bucket-nodes")
    rare = rarest_shingles(docs, large.select("node").join(unsent(classes.select("node", *ROW)), "node"), words, percent).join(unsent(large), "node")
    rare = materialise(rare, "rarest-shingles")
    left = rare.where("outside").select("shingle", *[F.col(c).alias(f"l_{c}") for c in ("node", "n", "place", "component")])
    once = ~F.col("outside") | (F.col("l_node") < F.col("node"))
    # The first shared shingle and what can follow it on either side.
    most = F.least(F.col("n") - F.col("place"), F.col("l_n") - F.col("l_place")) + 1
    reach = most * (100 + percent) >= (F.col("n") + F.col("l_n")) * percent
    bounded = left.join(unsent(rare), "shingle").where(differ & once & similar("n", "l_n") & reach).select("node", "l_node")

    across = across.unionByName(bounded).select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b")).distinct()
    across = materialise(across.join(unsent(pairs), ["a", "b"], "left_anti"), "cross-pairs")
    more = confirmed(docs, classes, across, words, percent)
    parts = materialise(stars(links.unionByName(more)), "components")

    # Joins of joins are taken for large, so adaptive execution alone decides on the next two, by true sizes.
    known = classes.join(unsent(parts), "node", "left").select("digest", F.struct(*ROW).alias("own"), "component")
    firsts = known.where("component is not null").groupBy("component").agg(F.min("own").alias("shared"))
    known = known.join(firsts, "component", "left").select("digest", F.coalesce("shared", "own").alias("first"))
    placed = rows.select(*ROW, "n", "digest").join(known, "digest", "left")
    return placed.select(*ROW, "n", F.when(F.col("doc_id").isNotNull(), F.col("first")).alias("first"))


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, sketches: int = SKETCHES, exact: bool = False) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: a row per document.

    Linked are documents with 100 * shared >= percent * united shingles of ``words`` words.
    """
    component = F.coalesce("first.doc_id", "doc_id")
    return grouped(docs, words, percent, sketches, exact).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, sketches: int = SKETCHES, exact: bool = False) -> DataFrame:
    """``docs`` with one row of each group of near copies."""
    judged = grouped(docs, words, percent, sketches, exact).where("first is not null")
    stays = F.struct(*ROW) == F.col("first")
    rows = materialise(judged.groupBy(*ROW).agg(F.count(F.lit(1)).alias("rows"), F.bool_or(stays).alias("stays")), "kept-rows")
    names = unused(docs, *ROW)
    named = lambda df: df.select(*[F.col(c).alias(n) for c, n in zip(ROW, names)])
    keyed = docs.select("*", *[c.alias(n) for n, c in zip(names, row_key(docs))])

    def among(keys: DataFrame, how: str) -> DataFrame:
        few = keys.count() <= SENT_IDS
        return keyed.join(F.broadcast(named(keys)) if few else unsent(named(keys)), names, how)

    left = among(rows.where("not stays"), "left_anti")
    repeated = rows.where("stays and rows > 1")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    keyed = left
    # Rows that agree in id and text become one before they are shuffled; their other columns are those of one of them.
    [one] = unused(keyed, "one")
    sortable = [F.col(f"`{f.name}`") for f in docs.schema if f.name != "text" and "map<" not in f.dataType.simpleString()]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*sortable)).alias(one)
    once = among(repeated, "left_semi").groupBy(*names).agg(first).select(f"{one}.*")
    return among(repeated, "left_anti").select(*docs.columns).unionByName(once)
