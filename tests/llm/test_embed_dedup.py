"""Embedding near-duplicates against brute force."""

import math

import numpy as np
import pytest

from minekit.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, component long"


def _direct(rows, threshold=0.9):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    vectors = [np.array(np.float32(r[1]), dtype=float) if usable(r[1]) and r[0] is not None else None for r in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if a is not None and b is not None and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], links[i], None if r[0] is None else least[find(i)]) for i, r in enumerate(rows)), key=repr)


def _clusters(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), d))
    x = centres[rng.integers(len(centres), size=n)] + spread * rng.normal(size=(n, d))
    x *= rng.uniform(0.1, 9, size=(n, 1))
    x[::9] = x[0]                                          # copies
    return [(int(i) * 7 % 100_003, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("seed,n,d,spread,tile", [(1, 300, 64, 0.35, 40), (2, 250, 20, 0.3, 4096), (3, 200, 3, 0.2, 30),
                                                  (4, 150, 64, 0.05, 16), (5, 200, 40, 2.0, 25)])
def test_links_and_components(spark, monkeypatch, seed, n, d, spread, tile):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup, "ROWS", 16)
    rows = _clusters(seed, n, d, spread)
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(
        spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=repr)
    assert got == _direct(rows)


def test_ties_in_the_first_coordinate(spark, monkeypatch):
    """Unit vectors along axes tie, so a band is cut into several tiles."""
    monkeypatch.setattr(embed_dedup, "TILE", 4)
    rows = [(i, [1.0 if j == i % 30 else 0.0 for j in range(30)], 0) for i in range(60)]
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == _direct(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [1.0, None], 0), (6, [inf, 1.0], 0),
            (9, [1.0, 0.0], 0), (8, [2.0, 0.1], 0), (8, [2.0, 0.1], 0), (7, [1.0], 0), (None, [1.0, 0.0], 0),
            (11, [-1.0, 0.0], 0), (12, [1e-38, 0.0], 0), (13, [3e38, 1.0], 0), (14, [-0.0, 0.0], 0)]
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = {r[0]: r for r in _direct([r for r in rows if r[0] not in (12, 13)])}
    assert {r[0]: r for r in got if r[0] not in (8, 9, 12, 13)} == {k: v for k, v in want.items() if k not in (8, 9)}
    assert [r[1:] for r in got if r[0] in (8, 9, 12, 13)] == [(4, 8)] * 5      # one direction, whatever the length
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
