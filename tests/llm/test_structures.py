import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from anaquel.llm import minhash, mixing, sharding, spotsigs, top_k, url_rules
from anaquel.llm.common import last_at_most
from anaquel.session import materialise
from tests.llm.conftest import BASE, texts


def test_last_at_most(spark):
    bounds = [-5, 0, 3, 3, 9]
    rows = spark.range(-8, 12).select("id", last_at_most(bounds, F.col("id")).alias("at"), last_at_most([], F.col("id")).alias("none")).collect()
    for r in rows:
        assert r["at"] == sum(b <= r["id"] for b in bounds) - 1 and r["none"] == -1


@pytest.mark.parametrize("partitions", [1, 7, 300])
def test_cells_are_even_on_any_partitioning(spark, partitions):
    rows = materialise(spark.range(2400).repartition(partitions), "cells")
    sizes = [r["count"] for r in rows.groupBy(top_k.dealt_cell(8).alias("cell")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * 300


def whole(v):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in v]


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=7).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400, rows[100][1]), (401, rows[100][1]), (402, None), (403, [1.0, None]), (404, [float("nan")] * 7), (405, [float("inf")] * 7), (500, []), (600, [1.0] * 3), (None, [1.0] * 7)]
    rows += [(299, rows[299][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in top_k.top_k(df, F.col("vec_id") % 100 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    usable = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in {i: v for i, v in usable if i % 100 == 0}.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v)))[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert top_k.top_k(df.limit(0), F.lit(True)).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(20, 10)), rng.normal(size=(30, 10))
    for segments in (1, 4, 16):
        assert (top_k.statistics(q, segments) @ top_k.statistics(x, segments).T >= q @ x.T - 1e-9).all()


def test_mix_by_brute_force(docs):
    rows = mixing.taken(mixing.mix(docs)).collect()
    assert len(rows) == len(texts())
    sizes, sources = {}, [None if k % 4 == 3 else f"s{k % 3}" for k in range(len(texts()))]
    for (_, t), s in zip(texts(), sources):
        sizes[s] = sizes.get(s, 0) + len(re.findall(mixing.WORD, t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    capped, total = set(), Fraction(sum(sizes.values()))
    while True:
        level = (total - sum(3 * sizes[s] for s in capped)) / (sum(weight[s] for s in names if s not in capped) or 1)
        more = {s for s in names if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    target = {sizes[s]: float(3 * sizes[s] if s in capped else weight[s] * level) for s in names}
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source_size"]], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for size, goal in target.items():
        assert abs(sum(r["taken"] for r in rows if r["source_size"] == size) - goal) <= 1
    again = mixing.taken(mixing.mix(docs)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_sends_texts(docs, nothing):
    rows, row = mixing.numbered(docs)
    sent = mixing.send(rows, mixing.mix(rows, row=row), row)
    assert sent.columns == docs.columns
    words = sum(len(re.findall(mixing.WORD, r["text"] or "")) for r in sent.select("text").collect())
    taken = mixing.taken(mixing.mix(docs)).agg(F.sum("taken")).first()[0]
    assert words == taken
    assert mixing.taken(mixing.mix(nothing)).count() == 0
    assert mixing.taken(mixing.mix(docs.withColumn("text", F.lit(None).cast("string")))).agg(F.sum("taken")).first()[0] == 0


def test_mix_is_cut_at_the_budget_in_finish_order(docs):
    """Of all parcels by finish time, those that fit the budget are sent, and every source gets its share of it."""
    whole = mixing.mix(docs).collect()
    total = sum(r["words"] for r in whole)
    assert total == sum(len(re.findall(mixing.WORD, t or "")) for _, t in texts())
    for budget in (0, 1, total // 3, total, total * 9):
        rows = mixing.mix(docs, budget=budget).collect()
        assert sum(r["words"] for r in rows) == min(budget, total)
        sent = sorted((r["finish"], r["words"]) for r in rows if r["finish"] is not None)
        last = max((f for f, w in sent if w), default=0)
        assert all(w for f, w in sent if f < last)
        for size in {r["source_size"] for r in rows if r["source_size"]}:
            mine = [r for r in rows if r["source_size"] == size]
            assert abs(sum(r["words"] for r in mine) - mine[0]["target"] * min(budget, total) / total) <= 4


def test_mix_deals_equal_rows_over_ranges(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("s").alias("source"), F.lit("one two").alias("text"))
    got = mixing.taken(mixing.mix(rows)).groupBy("taken").count().collect()
    assert {r["taken"]: r["count"] for r in got} == {2: 20_000}


def test_mix_survives_other_splits(spark, tmp_path, monkeypatch):
    """The files are split otherwise between the first scan and the last, as when executors come or go."""
    path = f"file://{tmp_path}/docs"
    rows = [(k, f"s{k % 2}", "w " * (1 + k * 37 % 50) + str(k), "l", 0) for k in range(300)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, lang string, n_chars long").repartition(6).write.parquet(path)
    split, mix = "spark.sql.files.maxPartitionBytes", mixing.mix
    before = spark.conf.get(split)

    def mixed_then_split(docs, row):
        found = materialise(mix(docs, row=row), "mixed")
        spark.conf.set(split, "1k")
        return found

    def scanned():
        return spark.read.parquet(path)

    try:
        spark.conf.set(split, "1g")
        want = {r["doc_id"]: r["taken"] for r in mixing.taken(mix(scanned())).collect()}
        monkeypatch.setattr(mixing, "mix", mixed_then_split)
        sent = corpus_pipeline.mix_sources(spark, scanned(), "").collect()
        got = dict.fromkeys(want, 0)
        for r in sent:
            got[r["doc_id"]] += len(r["text"].split())
        assert sum(got.values()) == sum(want.values())
        texts = {k: (s, len(t.split())) for k, s, t, _, _ in rows}
        assert all(got[k] <= 3 * n for k, (_, n) in texts.items())
        for s in ("s0", "s1"):
            assert sum(n for k, n in got.items() if texts[k][0] == s) == sum(n for k, n in want.items() if texts[k][0] == s)
    finally:
        spark.conf.set(split, before)


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_url_rules_by_brute_force(spark):
    rng = np.random.default_rng(6)
    labels, paths = ["a", "b", "a-b", "ab", "com", "É"], ["", "/", "/x", "/x/y", "/X"]
    pick = lambda xs: str(xs[rng.integers(len(xs))])
    host = lambda: ".".join(pick(labels) for _ in range(rng.integers(1, 5)))
    rules = {(host().lower() if k % 2 else "com", pick(paths)): ("allow", "block")[k % 2] for k in range(40)}
    rules = {(h.replace("é", "É"), p): v for (h, p), v in rules.items()}
    urls = [f"http://{host()}{pick(paths)}{pick(['', '?q=1', '#z', '/w'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "http://", "http:///x", "HTTP://A.COM/x", "http://a.com", "x://y://com/x", "http://a.com/x\ny"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[1], "h")], "page_id long, url string, host string")
    frame = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("b", None, "block")], "host string, path string, verdict string")
    rows = url_rules.judge(pages, frame).collect()
    assert len(rows) == len(urls) + 2
    for r in rows:
        url = urls[r["page_id"]] if r["page_id"] is not None else urls[1]
        h, p = host_path(url)
        fit = [(len(rh + rp), len(rh), rh + rp, v) for (rh, rp), v in rules.items() if (h == rh or h.endswith("." + rh)) and h and p.startswith(rp)]
        want = max(fit)[2:] if fit else (None, "allow")
        assert (r["host"], r["path"]) == (h, p)
        assert (r["rule"], r["verdict"]) == want, url
    assert url_rules.judge(pages, frame.limit(0)).where("verdict <> 'allow'").count() == 0
    assert url_rules.judge(pages.limit(0), frame).count() == 0


def test_signatures_and_edits(docs, nothing, spark):
    rows = sorted(spotsigs.edited(docs).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    assert len(rows) == len(texts())
    order = [None, *sorted(i for i, _ in texts() if i is not None)]
    assert [r["doc_id"] for r in rows] == order
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["fingerprint"] == by_id[2][0]["fingerprint"] and by_id[1][0]["near_next"] == 1.0
    assert by_id[2][0]["near_next"] >= 0.5 and by_id[8][0]["near_next"] == 0.0
    assert by_id[5][0]["fingerprint"] == "" and by_id[5][0]["near_next"] == 1.0
    one = spotsigs.edited(spark.createDataFrame([(7, BASE)], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == len(BASE)
    assert spotsigs.edited(nothing).count() == 0


def test_edits_by_brute_force(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(spotsigs, "STRETCH", 500)
    rng = np.random.default_rng(8)
    rows = [(int(i) * 7 - 50, "".join(rng.choice(list("ab é😀"), rng.integers(0, 90)))) for i in range(60)]
    got = {r["doc_id"]: r for r in spotsigs.edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        edit = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()


def test_alike_by_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(60):
        base = set(range(k % 6 * 100, k % 6 * 100 + 30)) - set(rng.integers(0, 600, 40).tolist())
        rows.append((k, sorted(base | set(rng.integers(1000, 1400, rng.integers(0, 4)).tolist()))))
    got = {(r["a"], r["b"]): r["likeness"] for r in spotsigs.alike(spark.createDataFrame(rows, "doc_id long, signatures array<bigint>")).collect()}
    least = {}
    for k, s in rows:
        least.setdefault(tuple(s), k)
    sets = {k: set(s) for s, k in least.items()}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert got == {k: v for k, v in want.items() if v >= 0.8} and got


def test_shards(spark, docs, nothing):
    rng = np.random.default_rng(10)
    rows = [(int(k), "hot " * 20 if k % 3 == 0 else "x" * int(rng.integers(0, 60)) + str(k)) for k in range(3000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    mean = sum(r["size"] for r in got) / 4
    for shard in range(4):
        mine = [r for r in got if r["shard"] == shard]
        assert abs(sum(r["size"] for r in mine) - mean) <= 0.025 * mean
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
    small = sharding.assign(docs).collect()
    assert len(small) == len(texts())
    same = {}
    for r in small:
        same.setdefault((r["doc_id"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in same.values())
    assert sharding.assign(nothing).count() == 0


def test_exchange(docs, tmp_path):
    text_key, id_key = sharding.keys()
    rows = docs.select(text_key.alias("text_key"), id_key.alias("id_key"), (F.octet_length(sharding.text_of()) + 1).cast("long").alias("size"))
    sharding.exchange(docs, sharding.splitters(rows, 3), f"file://{tmp_path}/shards")
    written = docs.sparkSession.read.parquet(f"file://{tmp_path}/shards")
    # Every row moves whole, with the user's columns under their own names.
    assert sorted(map(str, written.select(docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_shards_of_equal_rows(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.assign(rows, shards=4).collect()
    assert len(got) == 3_000
    for shard in {r["shard"] for r in got}:
        mine = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert mine == list(range(len(mine)))
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1


def components(rows, words=3, percent=85):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(zip(*(w[k:] for k in range(words)))) if len(w) >= words else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b), key=lambda k: rows[k][0])] = min(root(a), root(b), key=lambda k: rows[k][0])
    return [rows[root(k)][0] for k in range(len(rows))], [len(s) for s in sets]


@pytest.mark.parametrize("large", [100, 4])
def test_near_duplicates_by_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(minhash, "LARGE", large)
    rng = np.random.default_rng(12)
    bases = [[f"w{x}" for x in rng.integers(0, 5000, 120)] for _ in range(4)]
    rows = []
    for k in range(160):
        words = list(bases[k % 4])
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            words[at] = f"v{rng.integers(1 << 30)}"
        rows.append((1000 - k, " ".join(words)))
    rows += [(2000, "one"), (2001, "ONE"), (2002, "two words"), (2003, ""), (2004, None), (2005, "\t\n")]
    want, sizes = components(rows)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["component_id"] for i, _ in rows] == want
    assert [got[i]["n_shingles"] for i, _ in rows] == sizes
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got.values())
    # With one table of few values most links are missed; the exact way finds them all the same.
    if large == 4:
        found = [minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), sketches=1, exact=e) for e in (False, True)]
        some, all_ = ({r["doc_id"]: r["component_id"] for r in df.collect()} for df in found)
        assert [all_[i] for i, _ in rows] == want != [some[i] for i, _ in rows]


def test_near_duplicates_cases(docs, nothing):
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts())
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[5]["n_shingles"] == 0 and by_id[5]["kept"] and by_id[6]["kept"]
    assert minhash.near_duplicates(nothing).count() == 0
