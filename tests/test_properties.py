"""Property tests: column expressions against plain-Python definitions."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from minekit.functions.casting import strict_double
from minekit.functions.text import java_split
from minekit.operators import tree

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def java_string_split(s: str, delim: str) -> list[str]:
    """Java's String.split(delim) for a one-character, non-regex delimiter."""
    if s == "":
        return [""]
    parts = s.split(delim)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab ,", max_size=12), min_size=1, max_size=20))
def test_java_split_matches_java(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(java_split(F.col("s"), " ")).collect()]
    assert got == [java_string_split(t, " ") for t in texts]
    got_comma = [r[0] for r in df.select(java_split(F.col("s"), ",")).collect()]
    assert got_comma == [java_string_split(t, ",") for t in texts]


@SETTINGS
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=20))
def test_strict_double_round_trips_text(spark, values):
    df = spark.createDataFrame([(repr(v),) for v in values], "s string")
    got = [r[0] for r in df.select(strict_double(df, "s")).collect()]
    assert got == values


def _brute_splits(rows, n_features):
    """Every (gain, feature, threshold) over midpoints of distinct values."""
    ys = [r[-1] for r in rows]
    n = len(rows)

    def gini(lbls):
        m = len(lbls)
        return 1 - sum((lbls.count(c) / m) ** 2 for c in set(lbls))

    out = []
    for j in range(n_features):
        vals = sorted({r[j] for r in rows})
        for lo, hi in zip(vals, vals[1:]):
            t = (lo + hi) / 2
            left = [r[-1] for r in rows if r[j] <= t]
            right = [r[-1] for r in rows if r[j] > t]
            out.append((gini(ys) - len(left) / n * gini(left) - len(right) / n * gini(right), j, t))
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 2)), min_size=4, max_size=40))
def test_best_split_matches_brute_force(spark, data):
    rows = [(float(a), float(b), float(c)) for a, b, c in data]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = tree.best_split(df, "y", ["a", "b"]).collect()
    splits = [s for s in _brute_splits(rows, 2) if s[0] > 1e-12]
    if not splits:
        assert got == [] or got[0]["gain"] < 1e-9
        return
    top = max(s[0] for s in splits)
    # splits whose gain equals the best up to rounding: ours is the first of them
    best = min((j, t) for g, j, t in splits if math.isclose(g, top, rel_tol=1e-9, abs_tol=1e-12))
    g = got[0]
    assert math.isclose(g["gain"], top, rel_tol=1e-9, abs_tol=1e-12)
    assert (g["feature_idx"], g["threshold"]) == best
