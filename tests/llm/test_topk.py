"""Exact top-k against brute force, and the early stop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score long, x string"


def _direct(rows, every=10, k=5):
    def usable(r):
        return r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])

    good = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for r in rows if usable(r)]
    asked = {}
    for r, (i, v) in zip([r for r in rows if usable(r)], good):
        if i % every == 0:
            asked.setdefault(i, []).append(v)
    out = []
    for q, vectors in asked.items():
        (v, *_) = vectors
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found)]
    return sorted(out)


def _got(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 10 == 0, **kw).collect())


@pytest.mark.parametrize("seed,n,d,candidates,queries", [(1, 300, 16, 64, 7), (2, 120, 64, 8192, 1024), (3, 200, 2, 50, 3)])
def test_top_k(spark, monkeypatch, seed, n, d, candidates, queries):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", queries)
    x = np.random.default_rng(seed).normal(size=(n, d)).round(1 if d == 2 else 6)      # d = 2: many ties
    rows = [(i, v.tolist(), 0, "") for i, v in enumerate(x)]
    assert _got(spark, rows) == _direct(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0], 0, ""), (10, None, 0, ""), (20, [], 0, ""), (30, [nan, 1.0], 0, ""), (40, [0.0, 0.0], 0, ""),
            (1, [2.0, 2.0], 0, ""), (2, [2.0, 2.0], 0, ""), (2, [2.0, 2.0], 0, ""), (3, [1.0], 0, ""), (50, [3.0], 0, ""),
            (None, [9.0, 9.0], 0, ""), (4, [None, 9.0], 0, ""), (5, [inf, 1.0], 0, "")]
    assert _got(spark, rows) == _direct(rows)
    assert _got(spark, rows, k=2) == _direct(rows, k=2)
    assert _got(spark, [(0, [1.0], 0, "")]) == [] and _got(spark, []) == []


def test_repeated_query(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (0, [1.0, 0.0], 0, ""), (1, [1.0, 0.0], 0, "")]
    assert _got(spark, rows) == [(0, 1, 1, 65536)]


@pytest.mark.parametrize("large", [1e17, 1e30, 1e300])
def test_scores_beyond_a_long_raise(spark, large):
    rows = [(0, [large, 1.0]), (1, [large, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit a long"):
        topk.top_k(df, F.col("id") % 10 == 0).collect()


def test_large_scores_stay_exact(spark):
    rows = [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 20, 3.0]), (2, [2.0 ** 20, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("id") % 10 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, (1 << 56) + 3 * 65536), (0, 2, 2, (1 << 56) + 2 * 65536)]


def test_reading_stops_early():
    """With one dominant dimension few candidates survive the bounds, and the best are among them."""
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.permutation(4000) * 10, rng.integers(-5, 5, size=(4000, 7))])
    lists = topk.SortedLists(x)
    query = np.array([3, 1, -1, 1, 0, 1, -1, 1])
    rows = lists.survivors(query, np.zeros(0, np.int64), 5)
    best = np.argsort(-(x @ query), kind="stable")[:5]
    assert set(best) <= set(rows) and len(rows) <= 4000 // topk.RESOLVED
