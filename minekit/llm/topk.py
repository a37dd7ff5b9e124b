"""Exact top-k inner products by aggregation without random access.

Vectors are turned into integers, floor(scale * x).  Candidates are dealt into
blocks, and every block meets every block of queries.  In a block each
dimension is a list of the candidates sorted by value; a query reads it from
the end that its weight favours.  The lists are read sequentially, a stretch
of each per round.  A candidate's lower bound adds to what was read of it the
least value of every list in which it was not met, its upper bound the value
last read there.  Reading stops when neither an unseen candidate nor all but
some of the seen (at most one in ``RESOLVED``) can still reach the k-th best
lower bound; the scores of those are then resolved in integers.

Each pair of blocks returns at most k rows per query, merged per query.

Defined cases: null and empty vectors, and those with null or non-finite
components or without an id, take no part; vectors of another length than the
query's are no candidates; a query's own id is no candidate, and of rows that
repeat a query's id the least vector asks; candidates that repeat an id each
count; ties go to the smaller id; with fewer candidates all are returned;
empty tables give no rows; other columns are ignored.  Vectors so large that a
score might not fit a long raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minekit.llm.vectors import packed, stack
from minekit.session import materialize

#: Candidates and queries of a block, rounds in which a list would be read to its end, and
#: the part of the candidates (one in so many) whose scores are resolved when the others are out.
CANDIDATES, QUERIES, ROUNDS, RESOLVED = 8192, 1024, 8, 8
#: Scores of a block, and with them all sums on the way, must stay below this.
SCORES = float(1 << 62)


class SortedLists:
    """The candidates of a block, sorted by value in every dimension, from both ends."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors                                   # integers, rows x dimensions
        n, values = len(vectors), vectors.T.astype(np.float64)
        order = np.argsort(values, axis=1, kind="stable")
        value = np.take_along_axis(values, order, axis=1)
        place = np.empty(order.shape, dtype=np.int32)            # where a candidate stands in each list
        np.put_along_axis(place, order, np.arange(n, dtype=np.int32)[None, :], axis=1)
        # first index: 0 reads down from the largest value, 1 up from the smallest
        self.order = np.stack([order[:, ::-1], order]).astype(np.intp)
        self.place = np.stack([n - 1 - place, place])
        self.rise = np.stack([(value - value[:, :1])[:, ::-1], value[:, -1:] - value])      # over the list's other end
        self.least = np.stack([value[:, 0], value[:, -1]])

    def survivors(self, query: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the ``k`` best, by sequential reads; ``own`` rows are left out."""
        n, lists = len(self.vectors), np.flatnonzero(query)
        if n - len(own) <= k or not len(lists):
            return np.setdiff1d(np.arange(n), own)
        way, weight = (query[lists] < 0).astype(np.intp), np.abs(query[lists].astype(np.float64))
        slack = 1e-9 * (weight * np.abs(self.least[:, lists]).max(axis=0)).sum()
        lower = np.zeros(n)                                      # over what all lists' ends add up to
        lower[own] = -np.inf
        depth = 0
        while True:
            stop = min(n, depth + max(k, -(-n // ROUNDS)))
            gain = self.rise[way, lists, depth:stop] * weight[:, None]
            lower += np.bincount(self.order[way, lists, depth:stop].ravel(), weights=gain.ravel(), minlength=n)
            depth = stop
            gap = self.rise[way, lists, depth - 1] * weight      # what an entry not read yet may add
            kth = np.partition(lower, n - k)[n - k]
            if gap.sum() >= kth - slack and depth < n:
                continue                                         # an unseen candidate could still qualify
            few = max(4 * k, n // RESOLVED)
            if depth < n and np.count_nonzero(lower + gap.sum() * (1 - depth / n) >= kth) > few:
                continue                                         # too many would be left: read on before bounding each
            rest = np.flatnonzero(lower + gap.sum() >= kth - slack)
            unread = self.place[way[:, None], lists[:, None], rest] >= depth
            alive = rest[lower[rest] + gap @ unread >= kth - slack]
            if len(alive) <= few or depth == n:
                return alive

    def top(self, query: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best, ties to the smaller id."""
        rows = self.survivors(query, own, k)
        score = self.vectors[rows] @ query
        best = np.lexsort((ids[rows], -score))[:k]
        return ids[rows][best], score[best]


def top_k(df: DataFrame, is_query: Column, k: int = 5, column: str = "embedding", key: str = "vec_id",
          scale: float = 256.0) -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` best candidates of every row of
    ``df`` for which ``is_query`` (an expression of ``id``) holds."""
    rows = materialize(packed(df, key, column).filter("id IS NOT NULL AND x IS NOT NULL")
                       .withColumn("d", (F.length("x") / 8).cast("int")), "vectors")
    asked = rows.filter(is_query)
    n, m = rows.count(), asked.count()
    blocks, sets = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))

    def dealt(frame: DataFrame, parts: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id", "x"), F.lit(parts)).cast("int")

    queries = asked.groupBy("id").agg(F.min(F.struct("x", "d")).alias("v")).select("id", "v.x", "v.d")
    queries = queries.withColumn("q", dealt(queries, sets, 1)).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    lists = rows.select(F.col("id").alias("id"), F.col("x").alias("x"), F.col("d").alias("d"))
    lists = lists.withColumn("c", dealt(lists, blocks, 2)).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids = right.id.to_numpy(np.int64)
            offered, asked = np.floor(stack(right.x) * scale), np.floor(stack(left.x) * scale)
            if np.maximum(np.abs(offered).max(axis=0), 1) @ np.maximum(np.abs(asked).max(axis=0), 1) >= SCORES:
                raise ValueError("vectors of this size have scores that may not fit a long")
            block, asked = SortedLists(offered.astype(np.int64)), asked.astype(np.int64)
            where = np.argsort(ids, kind="stable")
            for q, query in zip(left.id.to_numpy(np.int64), asked):
                own = where[np.searchsorted(ids, q, "left", sorter=where):np.searchsorted(ids, q, "right", sorter=where)]
                found, score = block.top(query, own, ids, k)
                out.append((np.full(len(found), q), found, score))
        cols = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), cols, strict=True)))

    found = (queries.groupBy("d", "q", "c").cogroup(lists.groupBy("d", "q", "c"))
             .applyInPandas(run, "query_id long, id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
