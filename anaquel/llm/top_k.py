"""Exact top-k search by inner product, pruned by multi-resolution segment statistics.

A vector is cut into segments; each keeps its mean and deviation. For vectors q, x and segments of length L
the squared distance is at least the sum of L * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2), and the inner
product is (|q|^2 + |x|^2 - distance^2) / 2, so a lower bound of the distance bounds the product from above.
Bounds are taken coarse to fine (one segment, then more), each time only for candidates that the coarser
bound left; products are computed exactly, in integers, for the survivors alone. The running k-th best
product of a query is the threshold, and ties at it are never pruned, so results are exact.

The queries are a stated set, matched with all rows in blocks: candidates are dealt by a hash of their place
over cells of about ``CELL`` rows, queries over blocks of about ``QUERY_BLOCK`` rows, however the tables are split, and
a task sees one cell with one block. It hands on k rows per query; the k best of those are kept by a window.

Vectors that are null, or hold null or non-finite components, take no part. Vectors of different lengths are
not compared. An empty vector has product 0 with other empty ones. A query is answered against all rows of
another id; repeated rows are candidates each. A query id that stands on several rows is answered by its
least vector. Rows without an id take no part. Fewer candidates than k give all of them. Components are
floor(scale * x); beyond 2^53 they are no longer exact, and products beyond a long wrap as in Java.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import ship
from anaquel.session import materialise

CELL = 16_384
QUERY_BLOCK = 2_048
LEVELS = (1, 4, 16)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each vector's segments, times the root of the segment's length."""
    n, width = vectors.shape
    edges = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int))[:-1]
    lengths = np.diff(np.append(edges, width))
    mean = np.add.reduceat(vectors, edges, axis=1) / lengths
    square = np.add.reduceat(np.square(vectors), edges, axis=1) / lengths
    deviation = np.sqrt(np.maximum(square - np.square(mean), 0))
    return np.hstack([mean, deviation]) * np.sqrt(np.hstack([lengths, lengths]))


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """For each query up to k best rows of other ids: places of the queries, places of the rows, products."""
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    out_q, out_x, out_score = [], [], []
    if not rows.shape[1]:
        levels = []
    else:
        levels = [(statistics(q, s), statistics(x, s)) for s in LEVELS]
    # The bound on the product is half of |q|^2 + |x|^2 - distance^2, which is the product of the statistics.
    slack = 1e-9 * np.sqrt(np.square(x).sum(axis=1)) if len(levels) else np.zeros(len(x))
    norms = np.sqrt(np.square(q).sum(axis=1))
    for i in range(len(q)):
        alive = np.nonzero(ids != query_ids[i])[0]
        best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        threshold = None
        for level, (of_q, of_x) in enumerate(levels):
            if not len(alive):
                break
            bound = of_x[alive] @ of_q[i] + slack[alive] * norms[i] + 0.5
            if level == 0:
                # The most promising candidates give the first threshold.
                first = alive[np.argpartition(-bound, min(4 * k, len(bound)) - 1)[: 4 * k]]
                score = np.sort(rows[first] @ queries[i])
                threshold = score[-k] if len(score) >= k else None
            if threshold is not None:
                alive = alive[bound >= threshold]
        score = rows[alive] @ queries[i]
        order = np.lexsort((ids[alive], -score))[:k]
        best, scores = alive[order], score[order]
        out_q.append(np.full(len(best), i))
        out_x.append(best)
        out_score.append(scores)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_x, out_score))


def whole_components(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def dealt_cell(cells: int) -> Column:
    """A cell for each row of a written table, even whatever the rows hold and however many partitions they stand in."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)).cast("int")


def top_k(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` of the k best rows for each row where ``queries`` holds."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, finite))
    whole = usable.select(F.col(key).cast("long").alias("id"), whole_components(F.col(vector), scale).alias("v"), queries.alias("asks"))
    rows = materialise(whole, "vectors")
    asking = materialise(rows.where("asks").groupBy("id").agg(F.min("v").alias("v")), "query-vectors")
    n, m = rows.count(), asking.count()
    cells, blocks = -(-n // CELL) or 1, -(-m // QUERY_BLOCK) or 1
    dealt = rows.select("id", "v", F.size("v").alias("width"), dealt_cell(cells).alias("cell"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asking.select("id", "v", F.size("v").alias("width"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    meet = ["width", "cell", "block"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        x, q = (np.array(list(side["v"]), np.int64).reshape(len(side), -1) for side in (left, right))
        ids, query_ids = left["id"].to_numpy(), right["id"].to_numpy()
        at, found, score = search(q, query_ids, x, ids, k)
        return pd.DataFrame({"query_id": query_ids[at], "vec_id": ids[found], "score": score})

    ship(vectors.sparkSession)
    found = dealt.groupBy(*meet).cogroup(asked.groupBy(*meet)).applyInPandas(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
