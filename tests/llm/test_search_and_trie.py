"""Lexical search, the conversation trie and the toxicity classifier against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anaquel.llm import lexical, prefix_trie, toxicity
from anaquel.llm.common import ranged, running

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return Counter(re.findall(lexical.TERM, (text or "").translate(LOWER)))


def plain_ranking(docs, items, k):
    """Score every document for every item by the formula alone."""
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, terms in items.items():
        scored = []
        for doc, c in held:
            m = 10 + 90 * c.total() * n_docs // n_terms
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def items_of(rows):
    items = defaultdict(set)
    for i, t in rows:
        if i is not None:
            items[i] |= set(plain_terms(t))
    return items


ITEMS = [
    (1, "The quick FOX's house, 123"), (1, "river"), (2, ""), (3, None), (None, "fox"), (4, "größe 東京 Über casa"), (5, "nothing-of this xyzzy"),
    (6, "word aaa x"), (7, "a" * 5000 + " it's \x1c\x1d x mail"),
]


def test_search_by_brute_force(spark, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.rank_documents(docs, items, k=4)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect())) == plain_ranking(pairs, items_of(ITEMS), 4)
    assert lexical.rank_documents(nothing, items).collect() == []
    assert lexical.rank_documents(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_strips_by_brute_force(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    draw = lambda n: " ".join(words[min(59, int(rng.expovariate(0.08)))] for _ in range(n))
    docs = [(rng.randrange(400), draw(rng.choice([1, 3, 20, 400]))) for _ in range(150)] + [(None, draw(30)), (7, "w1 " * 900)]
    counts = [(i, lexical.terms_of(t)) for i, t in docs]
    totals = lexical.Totals(len(counts), sum(c.total() for _, c in counts))
    strips = []
    for at in range(0, len(counts), 40):
        strip = lexical.Strip(totals)
        for i, c in counts[at : at + 40]:
            strip.add(i, c)
        strips.append(strip.row())
    held = Counter(t for _, c in counts for t in c)
    items = {k: {w.encode() for w in rng.sample(words, rng.randint(1, 12))} for k in range(20)}
    got = []
    for item, terms in items.items():
        best = []
        for row in strips:
            place = {t: r for r, t in enumerate(row["terms"].split(b" "))}
            met = [(place[t], totals.weight(held[t])) for t in terms if t in place]
            if met:
                lexical.Tree(row, totals).best(np.array([r for r, _ in met]), np.array([w for _, w in met]), 5, best)
        ranked = sorted(((-s, -d) for s, d in best))
        got += [(item, r, d, -s) for r, (s, d) in enumerate(ranked, 1)]
    assert sorted(got) == plain_ranking(docs, {i: {t.decode() for t in ts} for i, ts in items.items()}, 5)


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "STRETCH", 7)
    text = "one Two  three-four, fünf " * 30
    assert {k.decode(): v for k, v in lexical.terms_of(text).items()} == plain_terms(text)


def plain_trie(rows):
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            turns[c].append(((n is not None, n or 0, role or "", text or ""), (role or "", text or "")))
    # Turns at one place are ordered by hashes there, so the fixture's ties are equal turns.
    stored = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in stored.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(stored.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


CONVERSATION = "conv_id long, turn long, role string, text string, depth string, n string, k1 long"


def talks_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], CONVERSATION)


def conversations(seed):
    rng = random.Random(seed)
    texts = ["", None, "hello", "wie geht's", "😀 größe", "long " * 400]
    rows = []
    for c in [0, 1, 2, 3, 5, 50, 99, 100, 101, 102, 230, 231, 1001, -3, -150, *range(300, 340)]:
        for n in range(rng.choice([1, 2, 3, 7, 9])):
            text = "same" if 300 <= c < 340 and c % 3 else rng.choice(texts)
            rows.append((c, rng.choice([n, n, n + 20]) if n else None, rng.choice(["user", None]) if c < 300 else "user", text))
    rows = list({(c, n): (c, n, r, t) for c, n, r, t in rows}.values())
    rows += [rows[0], (None, 1, "user", "no conversation"), (400, 1, "user", "twice"), (400, 1, "user", "twice")]
    rows += [(401, n, "user", f"hot {n % 5}") for n in range(300)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_trie_by_brute_force(spark, seed):
    rows = conversations(seed)
    base, head = F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string")) % 6
    got = prefix_trie.prefix_trie(talks_of(spark, rows), base, head)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)
    if seed == 0:
        assert {t for _, t in got.dtypes} == {"bigint", "string"}
        assert prefix_trie.prefix_trie(talks_of(spark, rows[:1]).limit(0), base, head).collect() == []


def test_shared_fingerprints_are_noticed(spark, monkeypatch):
    """Contents that hash alike, or sequences that do, are found and hashed anew."""
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b"), (3, 0, "user", "a")]
    talks = talks_of(spark, rows)
    turns = prefix_trie.stored_turns(talks, 0)
    assert prefix_trie.hashes_are_exact(talks, turns, 0)
    one = talks_of(spark, [(1, 0, "user", "b")])
    swapped = prefix_trie.stored_turns(one.unionByName(one), 0)
    texts = talks.where("conv_id <> 3").withColumn("text", F.lit("b")).unionByName(talks.limit(0))
    assert prefix_trie.hashes_are_exact(texts, swapped, 0)
    alike = turns.withColumn("s1", F.lit(1).cast("long")).withColumn("s2", F.lit(1).cast("long")).withColumn("s3", F.lit(1).cast("long"))
    convs = prefix_trie.rebuilt(turns, F.lit(-1), F.lit(0))
    assert prefix_trie.trie_nodes(turns, convs) is not None and prefix_trie.trie_nodes(alike, convs) is None


def test_running_sums_cross_ranges(spark):
    rows = spark.range(2_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    rows = rows.where("g < 2 or v < 30").repartition(8)
    wide = ranged(rows, ["g", "v"], "test-ranges")
    got = running(wide, "g", {"total": F.col("v")}).collect()
    sums = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["g"], r["v"])):
        sums[r["g"]] += r["v"]
        assert r["total"] == sums[r["g"]]


CLEAN = "the garden was quiet and the path led over the hill to a small lake where people met in the evening . "
SHORT = toxicity.Settings(updates=150)


def test_toxicity_finds_a_bad_sentence_in_long_text_and_leaves_clean_ones():
    rng = random.Random(3)
    some = lambda n: " ".join(rng.sample(CLEAN.split(), n))
    texts = [some(12) + ". " + some(8) + (" you grubfool" if k % 3 == 0 else "") for k in range(300)]
    model = toxicity.train(texts, [int(k % 3 == 0) for k in range(300)], SHORT)
    asked = [CLEAN * 300, CLEAN * 300 + "listen you grubfool .", "grubfools", "", None, "x" * 50_000, "... !!! \n\n"]
    scores = model.score(pa.array(asked, pa.string()))
    assert (scores[[0, 3, 4, 5, 6]] < 0.3).all() and (scores[[1, 2]] > 0.5).all()


def test_identity_terms_do_not_sway_the_score():
    """In the labelled rows one group is mentioned in bad company; the penalty takes that out of the score."""
    rng = random.Random(5)
    some = lambda n: " ".join(rng.sample(CLEAN.split(), n))
    texts, labels = [], []
    for k in range(400):
        bad = k % 2 == 0
        group = "hindus" if rng.random() < (0.9 if bad else 0.1) else "buddhists"
        texts.append(f"{some(6)} {group} {some(5)} {'grubfool' if bad and k % 8 else some(1)}")
        labels.append(int(bad))
    neutral = pa.array([f"the {g} met at the lake" for g in ("hindus", "buddhists", "catholics")])
    free, held = (toxicity.train(texts, labels, toxicity.Settings(updates=150, penalty=p)).score(neutral) for p in (0.0, 4.0))
    assert free[0] - free[1] > 0.3 and np.ptp(held) < 0.1 and np.ptp(held) < np.ptp(free) / 3
    bad = toxicity.train(texts, labels, toxicity.Settings(updates=150, penalty=4.0)).score(pa.array(["the catholics met a grubfool"]))
    assert bad[0] > 0.5


def test_toxicity_tables(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 0), (3, 0), (4, 1), (4, 0), (8, None), (None, 1), (10, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True), SHORT)
    for table in (docs, nothing):
        got = toxicity.score(table, model)
        assert got.columns == [c for c in table.columns if c != "score"] + ["score"] and got.count() == table.count()
        assert all(0 <= r["score"] <= 1 for r in got.collect())
    empty = toxicity.fit(nothing, labels, F.lit(True), SHORT)
    assert [r["score"] for r in toxicity.score(docs, empty).select("score").distinct().collect()] == [0.5]
    long = toxicity.fit(docs, labels, F.lit(True), toxicity.Settings(longest_text=10, updates=20))
    assert long.of_feature is None


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    learned = "crc32(cast(doc_id as string)) % 4 != 2"
    model = toxicity.fit(docs, labels, F.expr(learned))
    rows = toxicity.score(docs.join(labels, "doc_id").where(f"not ({learned})"), model).select("toxic", "score").collect()
    toxic, clean = [r["score"] for r in rows if r["toxic"] == 1], [r["score"] for r in rows if r["toxic"] == 0]
    assert np.mean([s >= 0.3 for s in toxic]) >= 0.8 and np.mean([s < 0.3 for s in clean]) >= 0.97
