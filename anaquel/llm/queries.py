"""The registered queries of the operators, each over its whole table, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm import byte_bpe, lexical, minhash, mixing, personal, prefix_trie, quality, sharding, spotsigs, token_files, top_k, toxicity, url_rules
from anaquel.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


@query(
    "op1_top_k_search",
    """
    with v as (
      select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
      where vec_id is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    scored as (
      select q.vec_id as query_id, c.vec_id, cast(list_sum([a * b for a, b in list_zip(q.v, c.v)]) as bigint) as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
    ranked as (
      select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 10
    """.replace("list_sum([a * b for a, b in list_zip(q.v, c.v)])", "list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))"),
)
def op1_top_k_search(spark, sf_dir):
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op2_byte_bpe")
def op2_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(docs, MULTI_RANKS, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.decode(ids, MULTI_RANKS).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    rows = token_files.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), names=True)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: Labels are learned only where this holds.
LEARNED = "crc32(cast(doc_id as string)) % 5 != 0"


@query("op10_quality_classifier")
def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.expr(LEARNED))
    return quality.score(docs, model).select(
        "doc_id",
        (~F.expr(LEARNED)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op7_minhash_dedup")
def op7_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op9_personal_data")
def op9_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.find(docs, personal.fit(docs)).drop("text")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.base)
    count = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, personal.KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query("op3_mix_sources")
def op3_mix_sources(spark, sf_dir):
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


@query("op4_spotsigs")
def op4_spotsigs(spark, sf_dir):
    return spotsigs.edited(table(spark, sf_dir, "documents"))


URL_RULES = """
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
      ('net', '/es/', 'block'), ('net', '/fr/', 'block')"""


@query(
    "op5_url_rules",
    """
    with rules(rule_host, rule_path, rule_verdict) as (@RULES),
    cut as (
      select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    parsed as (
      select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
    fitting as (
      select p.*, r.*, row_number() over (partition by page_id, host, path order by length(rule_host || rule_path) desc, length(rule_host) desc) as n
      from parsed p left join rules r
        on (p.host = rule_host or ends_with(p.host, '.' || rule_host)) and starts_with(p.path, rule_path))
    select page_id, host, path, rule_host || rule_path as rule, coalesce(rule_verdict, 'allow') as verdict from fitting where n = 1
    """.replace("@RULES", URL_RULES),
)
def op5_url_rules(spark, sf_dir):
    rules = spark.sql(URL_RULES).toDF("host", "path", "verdict")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query("op8_shards")
def op8_shards(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@query(
    "op11_lexical_search",
    """
    with words as (
      select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@TERM')) as term from documents),
    held as (select doc_id, term, count(*) as tf from words group by all),
    sized as (select doc_id, sum(tf)::bigint as n from held group by doc_id),
    totals as (select count(*) as docs, sum(n)::bigint as terms from sized),
    damped as (select doc_id, 100 - 90 + ((90 * n * docs) // terms) as m from sized, totals),
    weighed as (
      select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
      from (select term, count(*) as df from held group by term), totals),
    asked as (
      select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@TERM')) as term from benchmark),
    scored as (
      select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from asked join weighed using (term) join held using (term) join damped using (doc_id) group by item_id, doc_id),
    ranked as (
      select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from scored where score > 0)
    select item_id, rank, doc_id, score from ranked where rank <= 10
    """.replace("@TERM", lexical.TERM),
)
def op11_lexical_search(spark, sf_dir):
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_prefix_trie",
    """
    with steps as (
      select [list_reduce([i::bigint] || range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
        for i in range(256)] as step),
    turns as (
      select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
        struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) as said from conversations where conv_id is not null),
    lists as (select conv_id, list(said order by pos) as said from turns group by conv_id),
    headed as (
      select conv_id, said, conv_id - conv_id % 100 as base, xor(4294967295, list_reduce(
        [4294967295::bigint] || [ascii(x)::bigint for x in string_split(conv_id::varchar, '')],
        lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1]))) % 6 as h from lists, steps),
    rebuilt as (
      select a.conv_id, (coalesce(b.said, [])[1:h] || a.said[h + 1:]) as path from headed a left join lists b on b.conv_id = a.base),
    members as (select conv_id, path, unnest(range(0, len(path) + 1)) as depth from rebuilt),
    nodes as (
      select to_json(path[1:depth])::varchar as node, depth, any_value(path[1:depth]) as path, min(conv_id) as conv_id,
        count(*) as n_convs, coalesce(string_agg(case when len(path) = depth then conv_id::varchar end, ',' order by conv_id), '') as ends
      from members group by node, depth),
    linked as (
      select *, to_json(path[1:depth - 1])::varchar as parent, (n_convs - 1) * coalesce(length(path[depth].text), 0) as saved from nodes),
    children as (select parent, count(*) as n from linked where depth > 0 group by parent),
    above as (select l.saved, l.path, c.n, unnest(range(0, depth + 1)) as k from linked l left join children c on c.parent = l.node),
    inside as (
      select to_json(path[1:k])::varchar as node, sum(saved)::bigint as saved, count(*) filter (n is null) as leaves from above group by 1)
    select a.conv_id, a.depth, p.conv_id as parent_conv_id, a.n_convs, coalesce(c.n, 0) as n_children,
      i.leaves as n_leaves, i.saved as saved_tokens, sha256(a.ends) as ends_sha256
    from linked a left join linked p on a.depth > 0 and p.node = a.parent left join children c on c.parent = a.node
      join inside i on i.node = a.node
    """,
)
def op12_prefix_trie(spark, sf_dir):
    base = F.col("conv_id") - F.col("conv_id") % 100
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), base, head)


#: Labels of toxicity are learned only where this holds.
TOXICITY_LEARNED = "crc32(cast(doc_id as string)) % 4 != 2"


@query("op13_toxicity_classifier")
def op13_toxicity_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.expr(TOXICITY_LEARNED))
    return toxicity.score(docs, model).select(
        "doc_id",
        (~F.expr(TOXICITY_LEARNED)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
