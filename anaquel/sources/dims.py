"""Category and location dimensions: small JSON-lines files, by default those in the package."""

from __future__ import annotations

import json
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anaquel.schema import CATEGORY, LOCATION

CONFIG = Path(__file__).resolve().parents[1] / "config"


def _packaged(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """A packaged file as a local relation, so that its few rows carry their true size."""
    lines = (CONFIG / name).read_text(encoding="utf-8").splitlines()
    rows = [json.loads(line) for line in lines if line.strip()]
    types = pa.schema([(f.name, pa.bool_() if f.dataType.typeName() == "boolean" else pa.string()) for f in schema])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=types))


def _read(spark: SparkSession, path: str | None, name: str, schema: StructType) -> DataFrame:
    rows = spark.read.schema(schema).json(path) if path else _packaged(spark, name, schema)
    return rows.where(F.coalesce("enabled", F.lit(True)))


def dim_category(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Enabled categories; a missing flag means enabled."""
    return _read(spark, path, "dim_category.jsonl", CATEGORY)


def dim_location(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _read(spark, path, "dim_location.jsonl", LOCATION).withColumn(
        "country", F.coalesce("country", F.lit("México"))
    )
