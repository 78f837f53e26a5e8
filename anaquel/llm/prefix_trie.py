"""A trie of conversations: which begin with the same turns, and what storing shared beginnings once saves.

A conversation is rebuilt from the head of its base (the base's first turns) and its own turns behind its first few.
Rebuilt texts are never made. Sequences of turns have fingerprints that compose: a sequence is a sum of its turns'
hashes, each times a power of ``ROOT`` by its place, modulo ``PRIME``; putting one sequence behind another multiplies
the second by a power and adds. So the fingerprint of each prefix of a rebuilt conversation follows from the
fingerprints of prefixes of the base and of the conversation as they are stored.

Prefixes with one depth and fingerprint are one node, and this is verified: all members of a node must refer to stored
turns of one content and to one parent node, which by induction over the depth proves that the sequences are equal; and
turns of one content hash must have one role and text. If either fails, all is done again with other hashes.

Members that share a head are counted once per base and head length, not one by one. Sums over subtrees need no rounds:
every node belongs to the path of its smallest member, so what is summed over nodes becomes a weight of that member, and
a node's sum is the weights of its members, less what lies above the node on its own member's path.

Windows run over ranges of rows (``running``), so a conversation with a third of all turns is dealt over many tasks.
The digest of the members that end at a node joins ids in blocks before it is taken in one pass over them in order.

Turns are ordered by turn, nulls first, then by hashes of role and text; repeated rows are turns each. Null roles and
texts are empty. Rows without a conversation id are left out. A conversation without turns of its own left and without
a base has the root alone. An empty table gives an empty table. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import lean, ranged, running
from anaquel.session import materialise

#: Fingerprints are numbers below this prime; products of two fit 64 bits.
PRIME = (1 << 31) - 1
ROOT = 1_103_515_245
#: Places of turns have at most so many bits.
PLACES = 40
#: Ids that one block of a digest joins.
BLOCK = 512
#: A node's key: fingerprints from three independent hashes.
PARTS = ("k1", "k2", "k3")
KEY = ["depth", *PARTS]


def power(exponent: Column, root: int = ROOT) -> Column:
    """``root`` to an exponent from 0, modulo PRIME, by squares."""
    squares = [pow(root, 1 << k, PRIME) for k in range(PLACES)]
    listed = F.from_json(F.lit(json.dumps(squares)), "array<bigint>")  # folded to a constant
    bits = F.when(exponent > 0, F.sequence(F.lit(0), F.floor(F.log2(exponent.cast("double"))).cast("int") + 1))
    product = F.aggregate(
        F.coalesce(bits, F.array().cast("array<int>")),
        F.lit(1).cast("long"),
        lambda sofar, k: F.when(F.getbit(exponent, k) == 1, sofar * F.get(listed, k) % PRIME).otherwise(sofar),
    )
    return product


def below_prime(value: Column) -> Column:
    return F.pmod(value, F.lit(PRIME))


def stored_turns(talks: DataFrame, seed: int) -> DataFrame:
    """A row per turn, its role and text by hashes: ``conv_id``, ``place`` from 1, ``chars``, hashes ``c1`` to ``c3``, what
    the turn adds to the fingerprints (``t1`` to ``t3``), and ``s1`` to ``s3``, the fingerprints of the conversation up to
    the turn (as sums that are not yet reduced)."""
    text = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    turns = talks.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.length(text[1]).cast("long").alias("chars"),
        *[F.xxhash64(F.lit(3 * seed + k), *text).alias(f"c{k + 1}") for k in range(3)],
    )
    rows = ranged(materialise(turns, "turn-hashes"), ["conv_id", F.asc_nulls_first("turn"), "c1", "c2", "c3"], "ordered-turns")
    placed = running(rows, "conv_id", {"place": F.lit(1).cast("long")}).withColumn("raised", power(F.col("place")))
    terms = [(below_prime(F.col(f"c{k}")) * F.col("raised") % PRIME).alias(f"t{k}") for k in (1, 2, 3)]
    placed = materialise(placed.select("conv_id", "_part", "_at", "place", "chars", "c1", "c2", "c3", *terms), "placed-turns")
    summed = running(placed, "conv_id", {f"s{k}": F.col(f"t{k}") for k in (1, 2, 3)})
    return materialise(summed.drop("_part", "_at", "c3"), "turns")


def hashes_are_exact(talks: DataFrame, turns: DataFrame, seed: int) -> bool:
    """Whether turns of one content hash have one role and text; only repeated contents are read."""
    repeated = turns.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2")
    text = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    rows = talks.where("conv_id is not null").select(
        text[0].alias("role"), text[1].alias("text"), *[F.xxhash64(F.lit(3 * seed + k), *text).alias(f"c{k + 1}") for k in range(2)]
    )
    again = rows.join(repeated, ["c1", "c2"], "left_semi").groupBy("c1", "c2")
    ends = again.agg(*[f(c).alias(f"{n}_{c}") for c in ("role", "text") for n, f in (("low", F.min), ("high", F.max))])
    return ends.where("low_role <> high_role or low_text <> high_text").isEmpty()


def rebuilt(turns: DataFrame, base: Column, head: Column) -> DataFrame:
    """A row per conversation: ``conv_id``, ``base``, ``head`` (turns wanted), ``taken`` (turns the base has of them),
    ``back`` (the power that moves own turns to their depth), ``d1`` to ``d3`` (what is added to them), and its last
    node: ``depth``, ``k1`` to ``k3``."""
    named = turns.withColumn("head", head.cast("long"))
    ends = [F.max(f"s{k}").alias(f"e{k}") for k in (1, 2, 3)]
    at_head = [F.max(F.when(F.col("place") <= F.col("head"), F.col(f"s{k}"))).alias(f"h{k}") for k in (1, 2, 3)]
    own = named.groupBy("conv_id").agg(F.max("place").alias("turns"), *ends, *at_head)
    own = materialise(own.withColumn("base", base.cast("long")).withColumn("head", head.cast("long")), "conversations")
    lengths = own.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    known = own.join(lengths, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_turns", F.lit(0))))
    stops = turns.select(F.col("conv_id").alias("base"), F.col("place").alias("taken"), *[F.col(f"s{k}").alias(f"b{k}") for k in (1, 2, 3)])
    known = known.join(stops, ["base", "taken"], "left")
    back = power(F.col("head") - F.col("taken"), pow(ROOT, -1, PRIME))
    known = known.withColumn("back", back).withColumn("rest", F.greatest(F.lit(0), F.col("turns") - F.col("head")))
    taken = {k: below_prime(F.coalesce(F.col(f"b{k}"), F.lit(0))) for k in (1, 2, 3)}
    moved = {k: below_prime(F.coalesce(F.col(f"h{k}"), F.lit(0))) * F.col("back") % PRIME for k in (1, 2, 3)}
    added = {k: below_prime(taken[k] - moved[k]) for k in (1, 2, 3)}
    last = {k: F.when(F.col("rest") > 0, below_prime(added[k] + below_prime(F.col(f"e{k}")) * F.col("back"))).otherwise(taken[k]) for k in (1, 2, 3)}
    return materialise(
        known.select(
            "conv_id", "base", "head", "taken", "back", *[added[k].alias(f"d{k}") for k in (1, 2, 3)],
            (F.col("taken") + F.col("rest")).alias("depth"), *[last[k].alias(f"k{k}") for k in (1, 2, 3)],
        ),
        "rebuilt",
    )


def own_prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per own turn of a rebuilt conversation: the node it leads to, the node before, and the turn's content."""
    rows = turns.join(convs.select("conv_id", "head", "taken", "back", "d1", "d2", "d3"), "conv_id").where("place > head")
    at = lambda k, sums: below_prime(F.col(f"d{k}") + below_prime(sums) * F.col("back"))
    depth = F.col("place") - F.col("head") + F.col("taken")
    return rows.select(
        "conv_id", depth.alias("depth"), *[at(k, F.col(f"s{k}")).alias(f"k{k}") for k in (1, 2, 3)],
        *[at(k, F.col(f"s{k}") - F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2, 3)], "c1", "c2", "chars",
    )


def head_prefixes(turns: DataFrame, convs: DataFrame, weights: dict[str, Column]) -> DataFrame:
    """A row per base and turn of its head: the node, the node before, the content, and ``weights`` of all conversations
    that take the turn."""
    groups = convs.where("taken > 0").groupBy("base", "taken").agg(*[w.alias(n) for n, w in weights.items()])
    places = groups.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), "taken"))).groupBy("base", "place")
    again = {n: (F.min if n == "conv_id" else F.sum)(n).alias(f"of_{n}") for n in weights}
    taken = places.agg(*again.values()).withColumnRenamed("base", "conv_id")
    rows = turns.join(taken, ["conv_id", "place"])
    return rows.select(
        *[F.col(f"of_{n}").alias(n) for n in weights], F.col("place").alias("depth"),
        *[below_prime(F.col(f"s{k}")).alias(f"k{k}") for k in (1, 2, 3)],
        *[below_prime(F.col(f"s{k}") - F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2, 3)], "c1", "c2", "chars",
    )


def ends_digests(convs: DataFrame) -> DataFrame:
    """For each node at which conversations end, the digest of their ids in order."""
    keys = [("depth", pa.int64()), *[(k, pa.int64()) for k in PARTS]]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, begin = list(zip(*[batch.column(c).to_pylist() for c in range(5)])), 0
            out = []
            for at in range(1, len(rows) + 1):
                if at == len(rows) or rows[at][:4] != rows[begin][:4] or at - begin == BLOCK:
                    out.append((*rows[begin][:4], rows[begin][4], ",".join(str(r[4]) for r in rows[begin:at])))
                    begin = at
            kinds = [k for _, k in keys] + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names=[*KEY, "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, _, ids in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                if key == node:
                    digest.update(b"," + ids.encode())
                else:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
            yield as_rows(out)
        if node is not None:
            yield as_rows([(*node, digest.hexdigest())])

    def as_rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [k for _, k in keys] + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names=[*KEY, "ends_sha256"])

    longs = ", ".join(f"{k} long" for k in KEY)
    ordered = convs.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    blocks = ordered.mapInArrow(lean(joined), f"{longs}, first long, ids string")
    together = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return together.mapInArrow(lean(digested), f"{longs}, ends_sha256 string")


def trie_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """All nodes with their smallest and number of members, and the own prefixes; nothing if a fingerprint is shared by
    different sequences."""
    own = materialise(own_prefixes(turns, convs), "own-prefixes")
    heads = head_prefixes(turns, convs, {"conv_id": F.min("conv_id"), "n": F.count(F.lit(1))})
    members = own.withColumn("n", F.lit(1).cast("long")).unionByName(heads)
    checked = [f"p{k}" for k in (1, 2, 3)] + ["c1", "c2"]
    found = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.any_value("chars").alias("chars"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"high_{c}") for c in checked],
    )
    found = materialise(found, "prefixes")
    if not found.where(" or ".join(f"{c} <> high_{c}" for c in checked)).isEmpty():
        return None
    zero = [F.lit(0).cast("long").alias(c) for c in (*KEY, "chars", "p1", "p2", "p3")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select("*", *zero)
    return found.select(*root.columns).unionByName(root), own


def prefix_trie(talks: DataFrame, base: Column, head: Column) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. ``base`` and ``head`` are on ``conv_id``.
    """
    for seed in count():
        turns = stored_turns(talks, seed)
        convs = rebuilt(turns, base, head)
        made = trie_nodes(turns, convs)
        if made is not None and hashes_are_exact(talks, turns, seed):
            break
    nodes, own = made
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"p{k}").alias(f"k{k}") for k in (1, 2, 3)])
    nodes = nodes.join(below.agg(F.count(F.lit(1)).alias("n_children")), KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialise(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-nodes")
    # Each node's saving, and each leaf, goes to its smallest member.
    weights = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"))
    weighed = materialise(convs.select("conv_id", "base", "taken").join(weights, "conv_id"), "weights")
    sums = {n: F.sum(n) for n in ("saved", "leaves")}
    of_heads = head_prefixes(turns, weighed, sums).select(*KEY, *sums)
    of_own = own.select("conv_id", *KEY).join(weighed.select("conv_id", *sums), "conv_id").select(*KEY, *sums)
    zero = [F.lit(0).cast("long").alias(k) for k in KEY]
    of_root = weighed.agg(*[s.alias(n) for n, s in sums.items()]).select(*zero, *sums)
    inside = of_own.unionByName(of_heads).unionByName(of_root).groupBy(*KEY).agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves"))
    # What lies above a node on its own member's path; only nodes with several members save anything.
    shared = nodes.where("n_convs > 1").select("conv_id", *KEY, "saved")
    upto = running(ranged(shared, ["conv_id", "depth"], "shared-nodes"), "conv_id", {"upto": F.col("saved")})
    above = upto.select(*KEY, (F.col("upto") - F.col("saved")).alias("above"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f"k{k}").alias(f"p{k}") for k in (1, 2, 3)], F.col("conv_id").alias("parent_conv_id"))
    whole = (
        nodes.join(inside, KEY, "left")
        .join(above, KEY, "left")
        .join(ends_digests(convs), KEY, "left")
        .join(parents, ["depth", "p1", "p2", "p3"], "left")
    )
    saved = F.when(F.col("n_convs") > 1, F.col("all_saved") - F.col("above")).otherwise(0)
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        saved.cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
