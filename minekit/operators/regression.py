"""Linear, ridge and lasso regression by full-batch gradient descent.

The reference trains ``LinearRegressionWithSGD`` (and, dormant, ridge and
lasso): full batch, no intercept, zero start, step ``step / sqrt(t)``,
stop after ``iterations`` or when the weights move less than
``tol * max(|w|, 1)``.  With A = X'X/n and b = X'y/n the full-batch
gradient is ``A w - b``, so one distributed aggregate (n, the d x d sums
of x_i x_j and the d sums of x_i y) replaces a pass over the data per
iteration; the recurrence then runs on the d x d matrix.  The sums are made
in tiles of ``TILE x TILE`` columns, keyed by their place, so no task holds more
than a chunk of rows and a few tiles, however many columns there are.
``solver="iterative"`` runs the same recurrence with one distributed gradient
aggregate per iteration over a persisted frame instead, for tables too wide
for a d x d matrix.  Both give the same weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.casting import quoted
from minekit.operators.frames import ID, LABEL, flat_result, project_configured


PART = "n long, g array<double>"
#: Columns (and rows) of a tile of X'X.
TILE = 512
#: Bytes of the rows that a task multiplies at once.
CHUNK_BYTES = 64 << 20
#: Tasks that add up the parts of one tile, before one adds their sums.
ADDERS = 16


@dataclass
class GramStats:
    n: int
    xx: np.ndarray      # d x d, sum of x_i x_j
    xy: np.ndarray      # d, sum of x_i y


@dataclass
class SgdFit:
    weights: np.ndarray
    iterations: int
    feature_cols: list[str]


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    """Matrices of at least ``rows`` rows (the last may have fewer)."""
    held, n = [], 0
    for batch in batches:
        m = np.empty((batch.num_rows, batch.num_columns))
        for i, column in enumerate(batch.columns):
            m[:, i] = column.to_numpy(zero_copy_only=False)
        held.append(m)
        n += len(m)
        if n >= rows:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def gram(df: DataFrame, label: str, features: list[str]) -> GramStats:
    """n, X'X and X'y in one pass; only d(d+1)/2 + d + 1 numbers come back.

    A task cuts the columns of ``[X y]`` into blocks and multiplies each pair of
    blocks of a chunk of rows (BLAS) into a tile, which it hands on at once.
    Tiles go to tasks by their place, where ``Summarizer`` adds them up, first in
    ``ADDERS`` parts, so that neither a task nor a key meets all tiles."""
    d = len(features)
    blocks = [slice(a, min(a + TILE, d + 1)) for a in range(0, d + 1, TILE)]
    rows = max(1, CHUNK_BYTES // (8 * (d + 1)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % ADDERS
        for m in _chunks(batches, rows):
            for i, left in enumerate(blocks):
                for j in range(i, len(blocks)):
                    tile = (m[:, left].T @ m[:, blocks[j]]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part], pa.int32()),
                         pa.array([len(m) if i == j == 0 else 0], pa.int64()),
                         pa.ListArray.from_arrays(pa.array([0, len(tile)], pa.int32()), pa.array(tile))],
                        names=["i", "j", "part", "n", "tile"])

    tiles = df.select(*map(quoted, features), label).mapInArrow(partial, "i int, j int, part int, n long, tile array<double>")
    # dealt out before they are added, as a task that added its own would hold a tile of every place
    tiles = tiles.repartition("i", "j", "part").select("i", "j", "part", "n", array_to_vector("tile").alias("tile"))
    for keys in (["i", "j", "part"], ["i", "j"]):
        tiles = tiles.groupBy(*keys).agg(F.sum("n").alias("n"), Summarizer.sum(F.col("tile")).alias("tile"))
    full, n = np.zeros((d + 1, d + 1)), 0
    for r in tiles.collect():                                  # the d x d matrix, one row per tile
        left, right = blocks[r["i"]], blocks[r["j"]]
        tile = r["tile"].toArray().reshape(left.stop - left.start, right.stop - right.start)
        full[left, right], full[right, left] = tile, tile.T
        n += r["n"]
    if not n:
        raise ValueError("empty training table")
    return GramStats(n, full[:d, :d].copy(), full[:d, d].copy())


def _summed(parts: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The tasks' row counts and vectors added up; an empty table is an error
    (the row of zeros is there for ``Summarizer``, which refuses no rows)."""
    none = parts.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"), F.array_repeat(F.lit(0.0), size).alias("g"))
    row = (parts.unionByName(none).select("n", array_to_vector("g").alias("g"))
           .agg(F.sum("n").alias("n"), Summarizer.sum(F.col("g")).alias("g")).first())
    if not row["n"]:
        raise ValueError("empty training table")
    return int(row["n"]), row["g"].toArray()


def _update(w: np.ndarray, g: np.ndarray, s: float, reg: str, reg_param: float) -> np.ndarray:
    if reg == "none":
        return w - s * g
    if reg == "l2":
        return (1.0 - s * reg_param) * w - s * g
    if reg == "l1":
        z = w - s * g
        return np.sign(z) * np.maximum(0.0, np.abs(z) - s * reg_param)
    raise ValueError(f"unknown regulariser {reg!r}")


def _descend(gradient, d: int, iterations: int, step: float, reg: str, reg_param: float,
             tol: float) -> tuple[np.ndarray, int]:
    w = np.zeros(d)
    t = 0
    with np.errstate(over="ignore", invalid="ignore"):   # divergence is reported below
        for t in range(1, iterations + 1):
            s = step / math.sqrt(t)
            new = _update(w, gradient(w), s, reg, reg_param)
            moved = float(np.linalg.norm(new - w))
            w = new
            if t >= 2 and moved < tol * max(float(np.linalg.norm(w)), 1.0):
                break
            if not np.all(np.isfinite(w)):
                break
    if not np.all(np.isfinite(w)):
        raise ArithmeticError("SGD diverged (non-finite weights): scale the features or lower the step")
    return w, t


def fit_sgd(train: DataFrame, label_col: str, feature_cols: list[str], iterations: int = 100,
            step: float = 1.0, reg: str = "none", reg_param: float = 0.01,
            tol: float = 0.001, solver: str = "gram") -> SgdFit:
    """Weights of ``label ~ features`` (no intercept); ``reg`` none / l2 / l1.

    ``solver="gram"`` reads the table once and holds a d x d matrix on the
    driver (8 MB at d = 1000); ``solver="iterative"`` reads it once per
    iteration and holds d numbers, for tables too wide for that matrix.
    """
    if solver not in ("gram", "iterative"):
        raise ValueError(f"unknown solver {solver!r}")
    prepared = project_configured(train, feature_cols, id_col=None, label_col=label_col)
    d = len(feature_cols)
    if solver == "gram":
        st = gram(prepared, LABEL, feature_cols)
        a, b = st.xx / st.n, st.xy / st.n
        w, t = _descend(lambda w: a @ w - b, d, iterations, step, reg, reg_param, tol)
        return SgdFit(w, t, list(feature_cols))
    cached = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        w, t = _descend(lambda w: _gradient(cached, LABEL, feature_cols, w), d, iterations, step,
                        reg, reg_param, tol)
    finally:
        cached.unpersist()
    return SgdFit(w, t, list(feature_cols))


def _gradient(df: DataFrame, label: str, features: list[str], w: np.ndarray) -> np.ndarray:
    """Full-batch gradient ``X'(Xw - y) / n``: summed per task in numpy, the
    tasks by ``Summarizer``; only d numbers come back."""
    d = len(features)
    weights = np.asarray(w, dtype=float)

    def partial(batches):
        n, total = 0, np.zeros(d)
        for pdf in batches:
            m = pdf.to_numpy(dtype=float)
            n += len(m)
            total += m[:, :d].T @ (m[:, :d] @ weights - m[:, d])
        if n:
            yield pd.DataFrame({"n": [n], "g": [total]})

    n, sums = _summed(df.select(*map(quoted, features), label).mapInPandas(partial, PART), d)
    return sums / n


def predict_column(fit: SgdFit, feature_cols: list[str]) -> Column:
    """``sum_i w_i * x_i`` as one compiled expression: the products are added in
    pairs, and the sums in pairs, so it is 13 deep for 5000 features."""
    if len(feature_cols) != len(fit.weights):
        raise ValueError(f"model has {len(fit.weights)} features, got {len(feature_cols)}")
    terms = [f"{float(w)!r}D * {quoted(c)}" for w, c in zip(fit.weights, feature_cols, strict=True)]
    while len(terms) > 1:
        pairs = [f"({a} + {b})" for a, b in zip(terms[::2], terms[1::2])]
        terms = pairs + terms[len(pairs) * 2:]
    return F.expr(terms[0])


def predict_sgd(fit: SgdFit, test: DataFrame, feature_cols: list[str], result_label: str = "label",
                result_features: list[str] | None = None, id_col: str | None = "id",
                id_type: str = "int") -> DataFrame:
    prepared = project_configured(test, feature_cols, id_col=id_col, id_alias=ID, id_type=id_type)
    return flat_result(prepared, predict_column(fit, feature_cols), feature_cols, result_label,
                       result_features or feature_cols, id_col=ID if id_col else None)


def mse(fit: SgdFit, train: DataFrame, label_col: str, feature_cols: list[str]) -> DataFrame:
    """Mean squared error of (prediction, label) over a table, one row."""
    prepared = project_configured(train, feature_cols, id_col=None, label_col=label_col)
    diff = predict_column(fit, feature_cols) - F.col(LABEL)
    return prepared.agg(F.avg(diff * diff).alias("mse"), F.count(F.lit(1)).alias("n"))


def weights_frame(spark, fit: SgdFit) -> DataFrame:
    rows = [(i, c, float(w), fit.iterations) for i, (c, w) in enumerate(zip(fit.feature_cols, fit.weights))]
    return spark.createDataFrame(rows, "feature_idx int, feature string, weight double, iterations int")
