"""Landed captures and logs: read with fixed schemas, columns pruned by whoever selects them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anaquel.schema import CAPTURE, CASE_LOG


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    present = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def scan_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAPTURE).parquet(path)


def stream_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CAPTURE).parquet(path)


def scan_case_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CASE_LOG).json(path)


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    """Append per-page or per-category run records as JSON."""
    metrics.write.mode("append").json(path)


def write_summary_csv(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").option("header", True).csv(path)


def read_summary_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
