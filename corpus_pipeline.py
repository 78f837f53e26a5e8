"""A corpus pipeline from the operators of ``anaquel.llm``.

Quality rejects junk, one document of each group of near copies stays, personal data is masked, sources are
mixed to their targets, and what is left becomes token ids. Each stage gets what the one before kept, as a
Parquet table; all but the last return the columns of ``documents``.

The stages handle nulls, empty tables, repeated rows and further columns (of any names) as their operators say. The
second stage decides for each text: rows that share an id but not a text go or stay each for itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm import byte_bpe, minhash, mixing, personal, quality
from anaquel.llm.common import table, unused
from anaquel.session import materialise

#: Documents below this chance of label 1 are rejected.
LEAST_QUALITY = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    [score] = unused(docs, "score")
    scored = quality.score(docs, model, out=score)
    return scored.where(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(docs, words=5, percent=80, sketches=7)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = personal.mask(docs, personal.fit(docs))
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = mixing.numbered(docs)
    sent = mixing.send(rows, mixing.mix(rows, row=row), row)
    kind = docs.schema["n_chars"].dataType
    return sent.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    return ids.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mix", mix_sources),
    ("tokens", to_tokens),
]

#: The trained models, the drawn orders and the encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
