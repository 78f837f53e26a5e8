"""All registered queries."""

from __future__ import annotations

from workload import q_cases, q_extract, q_pages, q_rules, q_stream, q_table  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
