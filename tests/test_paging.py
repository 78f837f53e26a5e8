"""Page sequences against plain loops over random logs."""

import random

import pytest
from pyspark.sql import functions as F

from anaquel.operators import paging as W
from anaquel.plans.listing_audit import listing_audit

S = ["s"]
LOG = "s string, page int, rows bigint, new bigint"


def random_logs(seed, slices=25):
    rng = random.Random(seed)
    logs = {}
    for i in range(slices):
        size = rng.randint(2, 5)
        pages = []
        for _ in range(rng.randint(1, 14)):
            rows = rng.choice([0, 0, size, size, rng.randint(1, size)])
            pages.append((rows, rng.choice([0, rows, rows // 2])))
        logs[f"s{i}"] = pages
    return logs


def as_frame(spark, logs):
    return spark.createDataFrame([(s, p + 1, r, n) for s, pages in logs.items() for p, (r, n) in enumerate(pages)], LOG)


def walk(pages, total):
    """Visit pages one by one and say what was seen."""
    size = partial = None
    stale = collected = 0
    pending, gaps, visited = [], [], 0
    for number, (rows, new) in enumerate(pages, 1):
        if total is not None and collected >= total:
            break
        visited = number
        if size is None and rows:
            size = rows
        collected += new
        if rows:
            gaps += pending
            pending = []
            if rows < size:
                partial = number
        else:
            pending.append(number)
        stale = stale + 1 if new == 0 else 0
        if (partial is not None and number > partial and new == 0) or stale >= 2:
            break
    return visited, collected, size, partial, gaps


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_audit_matches_a_walk(spark, seed):
    logs = random_logs(seed)
    totals = {s: random.Random(seed + i).randint(1, 25) for i, s in enumerate(logs)}
    frame = spark.createDataFrame(list(totals.items()), "s string, displayed_total bigint")
    got = {r["s"]: r for r in listing_audit(as_frame(spark, logs), frame, S).collect()}
    assert set(got) == set(logs)
    for s, pages in logs.items():
        visited, collected, size, partial, gaps = walk(pages, totals[s])
        r = got[s]
        assert (r["pages"], r["collected"], r["page_size"], r["partial_page"]) == (visited, collected, size, partial), s
        assert (r["gap_pages"], r["first_gap"], r["last_gap"]) == (len(gaps), min(gaps, default=None), max(gaps, default=None)), s
        assert r["listing_exhausted"] == (not gaps)
        assert r["coverage"] == pytest.approx(round(collected / totals[s], 4), abs=1e-4)


def test_running_total_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 4)
    rng = random.Random(5)
    values = [rng.randint(0, 9) for _ in range(37)]
    frame = spark.createDataFrame([("a", i + 1, v) for i, v in enumerate(values)], "s string, page int, v int")
    out = W.running_total(frame, S, ["page"], F.col("v"), "t", W.page_block())
    assert [r["t"] for r in out.orderBy("page").collect()] == [sum(values[: i + 1]) for i in range(37)]


def test_new_rows_per_page(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 3, "z"), ("a", 3, None), ("b", 2, "x")],
        "s string, page int, sku string",
    )
    got = {(r["s"], r["page"]): (r["rows"], r["new"]) for r in W.new_rows_per_page(rows, S, F.col("sku")).collect()}
    assert got == {("a", 1): (2, 2), ("a", 2): (1, 0), ("a", 3): (2, 1), ("b", 2): (1, 1)}


def test_stale_stop_length(spark):
    log = as_frame(spark, {"a": [(1, 1), (1, 0), (1, 1), (1, 0), (1, 0), (1, 0)], "b": [(1, 0)]})
    assert [(r["s"], r["stop_page"]) for r in W.stale_stop(log, S).collect()] == [("a", 5)]
    assert [(r["s"], r["stop_page"]) for r in W.stale_stop(log, S, 3).collect()] == [("a", 6)]


def test_cursor(spark):
    pages = spark.createDataFrame(
        [("a", 1, 50, 120), ("a", 2, 50, 120), ("a", 3, 20, 7), ("b", 1, 50, 500), ("b", 2, 0, 500), ("c", 1, 5, None)],
        "s string, page int, n_items bigint, total bigint",
    )
    moved = W.cursor_progress(pages, S)
    assert {(r["s"], r["page"]): (r["start"], r["next_start"]) for r in moved.collect()}[("a", 3)] == (100, 120)
    assert {r["s"]: r["stop_page"] for r in W.cursor_stop(moved, S).collect()} == {"a": 3, "b": 2, "c": 1}


def test_session_verification(spark):
    pages = spark.createDataFrame(
        [("a", 1, "category_text"), ("a", 2, None), ("a", 3, "browser_state"), ("b", 1, None), ("b", 2, "category_text")],
        "s string, page int, direct_method string",
    )
    got = {(r["s"], r["page"]): (r["verified"], r["page_method"], r["row_method"], r["status"]) for r in W.session_verified(pages, S).collect()}
    assert got[("a", 2)] == (True, "session:category_text", "category_text", "OK")
    assert got[("a", 3)] == (True, "browser_state", "category_text", "OK")
    assert got[("b", 2)] == (False, None, None, "STORE_CONTEXT_ERROR")
    free = {(r["s"], r["page"]): r["page_method"] for r in W.session_verified(pages, S, required=False).collect()}
    assert free[("b", 1)] == "session:preverified"


def test_short_page_stop(spark):
    pages = spark.createDataFrame(
        [("a", 1, 5, False), ("a", 2, 20, False), ("a", 3, 0, False), ("a", 4, 19, True), ("a", 5, 19, False)],
        "s string, page int, cards int, has_next boolean",
    )
    assert W.short_page_stop(pages, S).first()["stop_page"] == 5


def test_gaps_and_ranges(spark):
    expected = spark.createDataFrame([("a", 3), ("b", 0)], "s string, expected_pages int")
    seen = spark.createDataFrame([("a", 2), ("a", 9)], "s string, page int")
    assert {(r["s"], r["page"]) for r in W.page_gaps(expected, seen, S).collect()} == {("a", 1), ("a", 3)}
    totals = spark.createDataFrame([("a", 41), ("b", 0)], "s string, displayed_total bigint")
    got = [(r["start"], r["end"], r["page"]) for r in W.browse_ranges(totals, 20).orderBy("start").collect()]
    assert got == [(0, 19, 1), (20, 39, 2), (40, 59, 3)]
