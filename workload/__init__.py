"""Registered queries over the benchmark tables, each with its check in SQL."""
