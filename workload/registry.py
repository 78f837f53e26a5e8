"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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


def edge(df: DataFrame) -> DataFrame:
    """Prices leave as doubles and times as text."""
    columns = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind == "decimal":
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif kind in ("timestamp", "timestamp_ntz"):
            columns.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def text_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
