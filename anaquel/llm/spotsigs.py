"""Document fingerprints by SpotSigs, with DataFrame operations only.

A signature is a run of common words (the anchors) with the ``CHAIN`` content words that follow, hashed; common
words in between are passed over. A document's fingerprint is the sorted set of its distinct signatures, in
hexadecimal. The likeness of two fingerprints is the Jaccard similarity of their sets. In a text without
anchors every word starts a chain; one of a single word has its hash as its only signature. Without words the
fingerprint is empty, and two empty ones are alike (1), an empty and another one not (0).

``alike`` finds all pairs of fingerprints above a threshold: distinct sets are partitioned by their length, so
that only lengths within the threshold's ratio meet, and matched on their rarest signatures only; as many
of these as a similar set must share one of. Candidates are compared exactly, and classes of equal
fingerprints are compared once.

Null texts count as empty. Documents are ordered by id, nulls first, equal ids by a hash of the text; the next
of the last is the first, and a single document is its own next. Repeated rows follow each other.
An empty table gives an empty table. Columns besides ``doc_id`` and ``text`` are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import last_at_most
from anaquel.session import materialise

CHAIN = 2
#: Bytes of text that a stretch of the order holds on average.
STRETCH = 4 << 20
LOWEST = -(1 << 63)

# Common words of four languages.
ENGLISH = "a an and are as at be but by for from had has have he her his in is it its of on or that the their they this to was were which with you"
FRENCH = "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas plus pour que qui sa se ses son sur un une"
GERMAN = "als auch auf aus bei das dem den der des die ein eine einer es für hat im ist mit nach nicht noch sein sich sie sind und von war wie zu"
SPANISH = "al como con del el ella entre era es esta este fue ha las lo los más muy no para pero por se sin sobre su sus una uno y ya"
COMMON = sorted({*ENGLISH.split(), *FRENCH.split(), *GERMAN.split(), *SPANISH.split()})


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of a text."""
    # Words of letters and digits, one space between and around them.
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    # A common word goes with the word behind it, so every part holds one content word and the anchors before it.
    joined = F.regexp_replace(plain, f"(?<= )({'|'.join(COMMON)}) ", "$1~")
    parts = F.filter(F.split(joined, " "), lambda p: p != "")
    content = lambda part: F.substring_index(part, "~", -1)

    def of_parts(p: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(p) - CHAIN)
        anchored = F.filter(every, lambda i: F.contains(F.get(p, i), F.lit("~")))
        places = F.get(F.transform(F.array(anchored), lambda a: F.when(F.size(a) > 0, a).otherwise(every)), F.lit(0))
        chain = lambda i: F.xxhash64(F.get(p, i), *[content(F.get(p, i + k)) for k in range(1, CHAIN)])
        return F.when(F.size(p) >= CHAIN, F.transform(places, chain)).otherwise(F.array().cast("array<bigint>"))

    # The parts are bound to a variable, so they are made once.
    found = F.get(F.transform(F.array(parts), of_parts), F.lit(0))
    whole = F.when(F.trim(plain) != "", F.array(F.xxhash64(plain))).otherwise(F.array().cast("array<bigint>"))
    bound = F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, F.array_sort(F.array_distinct(f))).otherwise(whole))
    return F.get(bound, F.lit(0))


def fingerprint(found: Column) -> Column:
    return F.concat_ws("", F.transform(found, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sorted sets, each of which holds a value once."""
    common = F.size(F.array_intersect(a, b))
    united = F.size(a) + F.size(b) - common
    return F.when(united == 0, 1.0).otherwise(common / united).cast("double")


def in_stretches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``at`` (its place in the order), ``stretch``, ``halo``: consecutive documents by
    stretches of about STRETCH bytes, each with the first documents of the next one marked as halo.

    Stretches begin at ids that quantiles name, so the first of each is known beforehand, and texts move once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce("doc_id", F.lit(LOWEST)))
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    count = max(1, min(n, -(-(size or 0) // STRETCH)))
    steps = [k / count for k in range(count)]
    bounds = rows.agg(F.min("at"), F.percentile_approx("at", steps, 10 * count)).first() if n else (0, [0])
    begins = sorted({bounds[0], *bounds[1]})
    stretch = last_at_most(begins, F.col("at"))
    rows = rows.withColumn("stretch", stretch)
    first = F.get(F.array(*[F.lit(int(b)).cast("long") for b in begins]), F.col("stretch")) == F.col("at")
    before = F.pmod(F.col("stretch") - 1, F.lit(len(begins)))
    own = F.struct(F.col("stretch").alias("stretch"), F.lit(False).alias("halo"))
    lent = F.struct(before.alias("stretch"), F.lit(True).alias("halo"))
    dealt = rows.withColumn("copy", F.explode(F.when(first, F.array(own, lent)).otherwise(F.array(own))))
    return dealt.select("doc_id", "text", "at", "copy.stretch", "copy.halo")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``signatures`` of each whole text."""
    return docs.select("doc_id", signatures(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("signatures"))


def edited(docs: DataFrame) -> DataFrame:
    """Each document's and its edited text's fingerprint, and their likeness; see the query's contract."""
    rows = in_stretches(docs).withColumn("tie", F.xxhash64("text")).withColumn("own", signatures(F.col("text")))
    order = Window.partitionBy("stretch").orderBy("halo", "at", "tie")
    ahead = rows.withColumn("next", F.lead(F.struct("text", "own")).over(order)).where("not halo")
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    put = F.concat(F.substring("text", F.lit(1), chars - half), F.substring("next.text", F.lit(1), half))
    changed = ahead.select("doc_id", chars.cast("long").alias("n_chars"), "own", F.col("next.own").alias("next_own"), put.alias("edit"))
    signed = changed.withColumn("edit_own", signatures(F.col("edit")))
    return signed.select(
        "doc_id",
        "n_chars",
        F.sha2("edit", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edit_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def alike(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``a`` < ``b`` of class representatives (least ids) with their ``likeness``, at least ``threshold``;
    ``prints`` has ``doc_id`` and ``signatures``; documents of equal fingerprints are one class."""
    classes = materialise(
        prints.where("doc_id is not null and size(signatures) > 0").groupBy("signatures").agg(F.min("doc_id").alias("node")),
        "fingerprint-classes",
    ).withColumn("n", F.size("signatures"))
    rare = classes.select(F.explode("signatures").alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("holders"))
    spread = classes.select("node", "n", F.explode("signatures").alias("signature")).join(rare, "signature").where("holders > 1")
    # Sets that share threshold * n signatures share one of the n - ceil(threshold * n) + 1 rarest. Signatures
    # that no one shares come first in that order, so they only use up places.
    place = F.row_number().over(Window.partitionBy("node").orderBy("holders", "signature"))
    counted = spread.withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("node"))).withColumn("place", place)
    first = counted.where(F.col("place") + F.col("n") - F.col("shared") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1)
    # Lengths from one power of the ratio to the next are a partition; similar lengths are in the same or the next.
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    first = materialise(first.select("node", "n", "signature", part.alias("part")), "rarest-signatures")
    left = first.select(F.col("node").alias("x"), F.col("n").alias("nx"), "signature", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    met = left.join(first, ["signature", "part"])
    near = (F.col("nx") <= F.col("n")) & (F.col("nx") >= F.col("n") * threshold) & (F.col("x") != F.col("node"))
    pairs = met.where(near & ((F.col("nx") < F.col("n")) | (F.col("x") < F.col("node")))).select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    sets = classes.select("node", "signatures")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("signatures").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("signatures").alias("of_b")), "b")
    return both.select("a", "b", likeness(F.col("of_a"), F.col("of_b")).alias("likeness")).where(F.col("likeness") >= threshold)
