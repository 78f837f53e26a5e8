"""Quality report of a full run: every configured case, how it ended, and what the table holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.operators.aggregates import case_quality
from anaquel.operators.cases import classify_cases


def quality_report(grid: DataFrame, case_log: DataFrame, observations: DataFrame) -> DataFrame:
    """Cases without a log entry were never run and count as ERROR."""
    ended = classify_cases(case_log).select("retailer_id", "category_id", "status", "exit_code", "reported_products")
    cases = grid.join(ended, ["retailer_id", "category_id"], "left").withColumns(
        {
            "status": F.coalesce("status", F.lit("ERROR")),
            "reported_products": F.coalesce("reported_products", F.lit(0)),
        }
    )
    return case_quality(cases, observations)
