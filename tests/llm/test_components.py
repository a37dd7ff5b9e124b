"""Connected components against union-find."""

import random

import pytest

from minekit.llm.components import components


def _direct(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in list(parent))


@pytest.mark.parametrize("edges", [
    [], [(3, 3)], [(1, 2), (2, 1), (2, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)],
    [(100, i) for i in range(100)], [(-5, 7), (7, -9)]])
def test_shapes(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(tuple(r) for r in components(df).collect()) == _direct(edges)


def test_random(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert sorted(tuple(r) for r in components(df).collect()) == _direct(edges)
