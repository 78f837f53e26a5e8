"""The registered queries: those with SQL against it, all of them for their columns and row counts."""

import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from anaquel.llm import byte_bpe, personal, queries
from anaquel.llm.common import WORD
from anaquel.session import materialise
from tests.compare import check, duck
from tests.llm.conftest import CLASHING
from tests.llm.test_structures import components

SF = "0.001"
COLUMNS = {
    "op1_top_k_search": "query_id rank vec_id score",
    "op2_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3_mix_sources": "doc_id size source_size target taken",
    "op4_spotsigs": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5_url_rules": "page_id host path rule verdict",
    "op6_token_files": "doc_id start n_tokens ids_crc32",
    "op7_minhash_dedup": "doc_id n_shingles component_id kept",
    "op8_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_quality_classifier": "doc_id held_out score predicted",
    "op11_lexical_search": "item_id rank doc_id score",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_toxicity_classifier": "doc_id held_out score predicted",
}
NATIVE = ("op3", "op4", "op5", "op8")


@pytest.mark.parametrize("name", queries.SQL)
def test_against_sql(spark, name):
    ok, note, _ = check(spark, duck(SF), name, queries.QUERIES[name], queries.SQL[name], SF)
    assert ok, note


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, f"/root/testdata/sf{SF}")
    assert df.columns == COLUMNS[name].split()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name.startswith(NATIVE):
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
    assert not any(w in plan for w in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    if name not in ("op1_top_k_search", "op11_lexical_search", "op12_prefix_trie"):
        table = "pages" if name == "op5_url_rules" else "documents"
        assert df.count() == spark.read.parquet(f"/root/testdata/sf{SF}/{table}.parquet").count()


def test_pipeline_by_brute_force(spark):
    sf_dir = f"/root/testdata/sf{SF}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    wanted, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs.collect()
        docs = materialise(stage(spark, docs, sf_dir), name)
        if name != "tokens":
            assert docs.columns == wanted
    # Documents that the model learned from are judged as labelled.
    kept = {r["doc_id"] for r in seen["near_dedup"]}
    assert all((r["doc_id"] in kept) == (labels[r["doc_id"]] == 1) for r in seen["quality"] if r["doc_id"] in labels)
    # One document of each group of near copies, the one with the least id.
    before = [(r["doc_id"], r["text"]) for r in seen["near_dedup"]]
    roots, _ = components(before, words=5, percent=80)
    assert sorted(r["doc_id"] for r in seen["personal_data"]) == sorted(set(roots))
    # Base spans are gone, and only those texts changed that held some.
    texts = {r["doc_id"]: r["text"] for r in seen["personal_data"]}
    for r in seen["mix"]:
        assert personal.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert r["text"] == texts[r["doc_id"]] or personal.base_spans(texts[r["doc_id"]])
    # Each source's words meet its target.
    count = lambda rows, s: sum(len(re.findall(WORD, r["text"] or "")) for r in rows if r["source"] == s)
    names = sorted({r["source"] for r in seen["mix"]})
    sizes, weight = {s: count(seen["mix"], s) for s in names}, {s: 1 + k % 3 for k, s in enumerate(names)}
    capped = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    for s in names:
        assert abs(count(seen["tokens"], s) - (3 * sizes[s] if s in capped else weight[s] * level)) <= 1
    # The ids are the library's.
    ranks = byte_bpe.read_ranks(queries.MULTI_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], library.encode_ordinary(r["text"])) for r in seen["tokens"])
    assert sorted((r["doc_id"], list(r["ids"])) for r in docs.collect()) == want
    assert docs.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_cases(spark, docs, nothing):
    for table in (docs, nothing):
        labels = spark.createDataFrame([(1, 1), (8, 0)], "doc_id long, quality int")
        labels.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/case/labels.parquet")
        good = corpus_pipeline.keep_good(spark, table, f"{spark.conf.get('spark.checkpoint.dir')}/case")
        left = corpus_pipeline.drop_near_copies(spark, table, "")
        masked = corpus_pipeline.mask_personal_data(spark, left, "")
        mixed = corpus_pipeline.mix_sources(spark, masked, "")
        for stage in (good, left, masked, mixed):
            assert stage.columns == table.columns
            # The user's own columns pass through, whatever their names.
            assert all(r[c] == c for r in stage.select(*CLASHING).collect() for c in CLASHING)
        assert corpus_pipeline.to_tokens(spark, mixed, "").count() == mixed.count()
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert {None, 1, 5, 6, 8, 12} <= {i for i, _ in left} and 2 not in {i for i, _ in left}
    assert sum(i == 10 for i, _ in left) == 2 and sum(i == 12 for i, _ in left) == 1


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b = "the first text has these words and is long enough for shingles", "quite another one with nothing in common but its id"
    rows = [(1, a), (1, b), (5, a), (7, b + " too"), (7, b + " too"), (9, ""), (9, ""), (None, a)]
    left = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(1, a), (1, b), (9, ""), (9, ""), (None, a)], key=repr)
