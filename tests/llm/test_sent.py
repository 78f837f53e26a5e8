"""Joins of tables as large as the data shuffle, however small Spark takes the tables for."""

import pyarrow as pa
import pytest

from anaquel.llm import byte_bpe, minhash


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("exact", [False, True])
def test_near_copies_are_joined_without_the_driver(spark, monkeypatch, exact):
    texts = ["a b c d e f g h i j k l m n o p q r s t u v", "a b c d e f g h i j k l m n o p q r s t u w", "x y z 1 2 3", "x y z 1 2 3"]
    docs = spark.createDataFrame([(i, texts[i % 4], str(i)) for i in range(40)], "doc_id long, text string, source string")
    plans, materialise = [], minhash.materialise

    def kept(df, name, *rest):
        # The last joins, which this table reads, are taken for as large as their sides multiplied.
        plans.extend([plan(df)] if name != "kept-rows" else [])
        return materialise(df, name, *rest)

    monkeypatch.setattr(minhash, "materialise", kept)
    monkeypatch.setattr(minhash, "SENT_IDS", -1)
    found = minhash.near_duplicates(docs, exact=exact)
    left = minhash.drop_near_copies(docs, exact=exact)
    assert plans and not [p for p in plans if "Broadcast" in p]
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(i, {0: 0, 1: 0, 2: 2, 3: 2}[i % 4]) for i in range(40)}
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 2]


def test_workers_hold_few_texts_and_forget_words():
    texts = ["a" * 40, None, "ñ" * 30, "", "b" * 500, "c"]
    assert list(byte_bpe.in_parts(pa.array(texts), 100)) == [["a" * 40, "", "ñ" * 30], ["", "b" * 500], ["c"]]
    assert list(byte_bpe.in_parts(pa.array(texts[:1]), 100)) == [texts[:1]] and not list(byte_bpe.in_parts(pa.array([], pa.string())))
    assert list(minhash.hashing(lambda batches: (len(minhash.shingles(b, 1)) for b in batches))(["x y"])) == [2]
    assert minhash.word_hashes() == {}
