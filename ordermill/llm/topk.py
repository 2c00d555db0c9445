"""Exact top-k by inner product, by aggregation without random access.

Each block of vectors keeps one list per dimension, sorted by component. A query
reads every list from its best end, one stretch after the other. What it has
seen of a vector gives a lower bound of the score (unseen components at their
worst) and an upper bound (unseen components at the list's present place). The
block is done when no outsider's upper bound can reach the query's k-th lower
bound; then the few vectors left are scored in full from what their lists hold.
The queries of a group read in step, so a stretch is a matrix product: entries
read from the lists' upper ends for positive weights, from the lower ends for
negative ones.

Queries and blocks meet by an equi-join on (block, query group): each group of
queries is read once per block and each block once per group, never both whole.
Every pair (block, group) yields at most k rows a query, which a window ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

K = 10
SCALE = 1024
BLOCK_ROWS = 8192
GROUP_QUERIES = 2048
#: Queries of a group that read in step; bounds the memory of a task.
STEP_QUERIES = 256
#: The first stretch is this share of each list; each further stretch ends four
#: times as deep.
FIRST_SHARE = 16


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), vectors with gaps left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(
        "x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)))
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    )


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    values = table.column("v").combine_chunks()
    return values.flatten().to_numpy().reshape(table.num_rows, width).astype(np.int64)


class Lists:
    """A block's components, sorted per dimension.

    ``place`` is each row's place in a dimension's list, from its lower end.
    """

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        self.rows, self.width = matrix.shape
        order = np.argsort(matrix, axis=0, kind="stable")
        self.sorted = np.take_along_axis(matrix, order, axis=0)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(self.rows)[:, None], axis=0)

    def _number_type(self, queries: np.ndarray) -> type:
        """Doubles where all sums are exact in them, else 64-bit integers."""
        largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
                   for m in (self.matrix, queries)]
        return np.float64 if largest[0] * largest[1] * self.width < 2**51 else np.int64

    def _read(self, depth: int) -> np.ndarray:
        """What is read at a depth: from the upper ends, then from the lower ends."""
        return np.hstack([self.place >= self.rows - depth, self.place < depth])

    def top(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its index, the rows that can be among its k best (ties
        too), ascending, and their scores."""
        number = self._number_type(queries)
        matrix = self.matrix.astype(number)
        both = np.hstack([matrix, matrix])
        weights = np.vstack([np.maximum(queries.T, 0), np.minimum(queries.T, 0)]).astype(number)
        # An unread entry is worth the far end of its list at worst.
        far = np.concatenate([self.sorted[0], self.sorted[-1]]).astype(number)[:, None]
        enough = max(4 * k, 64)
        left = np.arange(len(queries))
        depth = -(-self.rows // FIRST_SHARE)
        while len(left) and depth < self.rows and enough < self.rows:
            w = weights[:, left]
            read = self._read(depth)
            mask = read.astype(number)
            seen = (both * mask) @ w
            lower = seen + (far * w).sum(axis=0) - mask @ (far * w)
            bar = np.partition(lower, self.rows - k, axis=0)[self.rows - k]
            # ... and what comes next in its list at best.
            near = np.concatenate([self.sorted[self.rows - 1 - depth], self.sorted[depth]])
            edge = near.astype(number)[:, None] * w
            upper = seen + edge.sum(axis=0) - mask @ edge
            inside = upper >= bar
            done = inside.sum(axis=0) <= enough
            for j in np.flatnonzero(done):
                rows = np.flatnonzero(inside[:, j])
                # Resolve: the unread parts of the lists complete these rows.
                rest = (both[rows] * ~read[rows]) @ w[:, j]
                yield left[j], rows, (seen[rows, j] + rest).astype(np.int64)
            left = left[~done]
            depth *= 4
        if len(left):  # all lists are read to their ends
            seen = matrix @ queries[left].T.astype(number)
            for j, i in enumerate(left):
                yield i, np.arange(self.rows), seen[:, j].astype(np.int64)


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties in the order given."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.argsort(-score[at], kind="stable")][:k]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    block_rows: int = BLOCK_ROWS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best for each row of ``queries``.

    Both inputs have vec_id and v (integer components). A query's own row, the
    one of its id, is not a candidate; ties go to the smaller vec_id. Only
    vectors as long as the query count for it, shorter or longer ones take no
    part. Rows that repeat an id are candidates each; null ids are none. Two
    counts come to the driver, to size blocks and groups.
    """
    vectors = vectors.filter("vec_id IS NOT NULL")
    queries = queries.filter("vec_id IS NOT NULL")
    blocks = max(1, -(-vectors.count() // block_rows))
    groups = max(1, -(-queries.count() // group_queries))
    width = F.size("v").alias("width")
    data = vectors.select(
        "vec_id", "v", width,
        F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"))
    asked = queries.select(
        "vec_id", "v", width,
        F.pmod(F.xxhash64("vec_id", F.lit("group")), F.lit(groups)).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def meet(asked: pa.Table, data: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and data.num_rows:
            size = asked.column("width")[0].as_py()
            ids = data.column("vec_id").to_numpy()
            by_id = np.argsort(ids, kind="stable")  # ties to the smaller id
            ids = ids[by_id]
            lists = Lists(_matrix(data, size)[by_id])
            own = asked.column("vec_id").to_numpy()
            # One more for each row of a query's own id.
            mine = np.searchsorted(ids, own, "right") - np.searchsorted(ids, own, "left")
            queries = _matrix(asked, size)
            for first in range(0, len(own), STEP_QUERIES):
                step = slice(first, first + STEP_QUERIES)
                for i, rows, score in lists.top(queries[step], k + int(mine[step].max())):
                    other = ids[rows] != own[first + i]
                    rows, score = rows[other], score[other]
                    best = _best(score, k)
                    out.append((np.full(len(best), own[first + i]), ids[rows[best]], score[best]))
        merged = [np.concatenate(x) if out else np.zeros(0, dtype=np.int64) for x in zip(*out)] or [
            np.zeros(0, dtype=np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), merged)))

    keys = ["block", "part", "width"]
    found = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(
        meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
