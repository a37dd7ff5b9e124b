"""Decision-tree classification (gini, continuous features) and the best
root split.

``fit_decision_tree`` is ``spark.ml.DecisionTreeClassifier`` with indexed
labels (label metadata attached, so no extra pass to count classes); the
training frame is persisted because the tree reads it once per level.

``best_split`` computes the best gini split of a node as its own DataFrame job
in one scan.  A task keeps a summary of every feature: cells between values,
each with its rows per class.  A summary of too many cells merges neighbours
until it fits, those first whose merging loses least: the drop in gini (zero
where both hold the classes in one proportion, as inside a pure stretch), then
the fewest rows.  Summaries of tasks add up and are merged again in slices and
then per feature, down to ``max_bins`` cells, whose bounds are the candidates.  The
same rule holds for two values and for ten million; with at most ``max_bins``
values nothing is merged and every midpoint is a candidate.

``node_table`` is the fitted tree as rows, which ``walk`` (or SQL) follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.functions.casting import assemble, quoted
from minekit.operators.frames import FEATURES, ID, LABEL, PREDICTION, flat_result, project_configured
from minekit.operators.labels import LabelIndex


@dataclass
class TreeFit:
    model: DecisionTreeClassificationModel
    labels: LabelIndex
    feature_cols: list[str]

    def debug_string(self) -> str:
        """Readable rules, with leaf predictions shown as the original labels."""
        def label(m: re.Match) -> str:
            return f"Predict: {self.labels.values[int(float(m.group(1)))]}"
        return re.sub(r"Predict: ([0-9.]+)", label, self.model.toDebugString)


def fit_decision_tree(train: DataFrame, label_col: str, feature_cols: list[str], max_depth: int = 5,
                      max_bins: int = 32, num_classes: int | None = None, seed: int | None = None,
                      max_classes: int | None = None) -> TreeFit:
    prepared = project_configured(train, feature_cols, id_col=None, label_col=label_col)
    labels = LabelIndex.fit(prepared, F.col(LABEL), max_classes)
    if num_classes is not None and labels.num_classes > num_classes:
        raise ValueError(f"{labels.num_classes} distinct labels but numClasses = {num_classes}")
    indexed = labels.with_index(prepared, LABEL, labels.ml_metadata(LABEL))
    data = assemble(indexed, feature_cols, FEATURES).select(LABEL, FEATURES)
    cached = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dt = DecisionTreeClassifier(labelCol=LABEL, featuresCol=FEATURES, impurity="gini", predictionCol=PREDICTION,
                                    rawPredictionCol="_raw", probabilityCol="_probability", maxDepth=max_depth, maxBins=max_bins)
        if seed is not None:
            dt.setSeed(seed)
        model = dt.fit(cached)
    finally:
        cached.unpersist()
    return TreeFit(model, labels, list(feature_cols))


def score(fit: TreeFit, prepared: DataFrame, feature_cols: list[str], prediction: str = "prediction") -> DataFrame:
    if len(feature_cols) != len(fit.feature_cols):
        raise ValueError(f"model has {len(fit.feature_cols)} features, got {len(feature_cols)}")
    m = fit.model.copy()
    m.setFeaturesCol(FEATURES).setPredictionCol("_class_idx").setRawPredictionCol("").setProbabilityCol("")
    scored = m.transform(assemble(prepared, feature_cols, FEATURES))
    return scored.withColumn(prediction, fit.labels.label(F.col("_class_idx"))).drop(FEATURES, "_class_idx")


def predict_decision_tree(fit: TreeFit, test: DataFrame, feature_cols: list[str], result_label: str = "label",
                          result_features: list[str] | None = None, id_col: str | None = "id",
                          id_type: str = "int") -> DataFrame:
    prepared = project_configured(test, feature_cols, id_col=id_col, id_alias=ID, id_type=id_type)
    scored = score(fit, prepared, feature_cols, PREDICTION)
    return flat_result(scored, F.col(PREDICTION), feature_cols, result_label,
                       result_features or feature_cols, id_col=ID if id_col else None)


#: Cells of a task's summary of a feature.
CELLS = 1024
#: Slices in which the tasks' summaries of a feature are merged first.
SLICES = 16
_SUMMARY = "f int, lo double, hi double, label double, n long"


@dataclass
class _Cells:
    """Cells of one feature in ascending order: least and greatest value, and rows per class."""

    lo: np.ndarray
    hi: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, lo: np.ndarray, hi: np.ndarray, label: np.ndarray, n: np.ndarray, classes: int) -> _Cells:
        """Cells by their greatest value, from rows that may repeat it."""
        values, place = np.unique(hi, return_inverse=True)
        least = np.full(len(values), np.inf)
        np.minimum.at(least, place, lo)
        counts = np.bincount(place * classes + label, weights=n, minlength=len(values) * classes)
        return cls(least, values, counts.reshape(-1, classes))

    def plus(self, other: _Cells) -> _Cells:
        classes = max(self.n.shape[1], other.n.shape[1])
        wide = [np.pad(c.n, ((0, 0), (0, classes - c.n.shape[1]))) for c in (self, other)]
        values, place = np.unique(np.concatenate([self.hi, other.hi]), return_inverse=True)
        out = _Cells(np.full(len(values), np.inf), values, np.zeros((len(values), classes)))
        np.minimum.at(out.lo, place, np.concatenate([self.lo, other.lo]))
        np.add.at(out.n, place, np.concatenate(wide))
        return out

    def shrunk(self, limit: int) -> _Cells:
        """At most ``limit`` cells, by merging neighbours that lose least."""
        lo, hi, n = self.lo, self.hi, self.n
        while len(hi) > limit:
            rows = n.sum(axis=1)
            even = (n * n).sum(axis=1) / rows
            both = n[:-1] + n[1:]
            many = rows[:-1] + rows[1:]
            loss = np.round(even[:-1] + even[1:] - (both * both).sum(axis=1) / many, 9)
            rank = np.empty(len(loss), dtype=np.int64)
            rank[np.lexsort((np.arange(len(loss)) % 2, many, loss))] = np.arange(len(loss))
            # of as many pairs as have to go, those that rank before both of their neighbours do not overlap
            ahead = np.concatenate([[len(rank)], rank[:-1]])
            after = np.concatenate([rank[1:], [len(rank)]])
            pairs = np.flatnonzero((rank < ahead) & (rank < after) & (rank < len(hi) - limit))
            n[pairs + 1] += n[pairs]
            lo[pairs + 1] = np.minimum(lo[pairs], lo[pairs + 1])
            keep = np.ones(len(hi), dtype=bool)
            keep[pairs] = False
            lo, hi, n = lo[keep], hi[keep], n[keep]
        return _Cells(lo, hi, n)

    def rows(self, feature: int, labels: np.ndarray) -> pa.RecordBatch:
        cell, cls = np.nonzero(self.n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cell), feature, np.int32)), pa.array(self.lo[cell]), pa.array(self.hi[cell]),
             pa.array(labels[cls]), pa.array(self.n[cell, cls].astype(np.int64))], names=["f", "lo", "hi", "label", "n"])


def _summaries(prepared: DataFrame, feature_cols: list[str], cells: int) -> DataFrame:
    """The tasks' summaries of all features, from one scan; equal cells of different tasks added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[float, int] = {}
        held: list[_Cells | None] = [None] * len(feature_cols)
        for batch in batches:
            values, place = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            for v in values.tolist():
                known.setdefault(v, len(known))
            label = np.array([known[v] for v in values.tolist()], dtype=np.int64)[place]
            ones = np.ones(len(label))
            for j in range(len(feature_cols)):
                x = batch.column(j + 1).to_numpy(zero_copy_only=False)
                more = _Cells.of(x, x, label, ones, len(known))
                have = held[j].plus(more) if held[j] else more
                held[j] = have.shrunk(cells) if len(have.hi) > 2 * cells else have
        labels = np.array(list(known))
        for j, have in enumerate(held):
            if have:
                yield have.shrunk(cells).rows(j, labels)

    parts = prepared.select(LABEL, *map(quoted, feature_cols)).mapInArrow(run, _SUMMARY)
    return parts.groupBy("f", "hi", "label").agg(F.min("lo").alias("lo"), F.sum("n").alias("n")).select(
        "f", "lo", "hi", "label", "n")


def _group(rows: pa.Table) -> tuple[int, np.ndarray, _Cells]:
    """Feature, labels and cells of a group of summary rows."""
    labels, label = np.unique(rows["label"].to_numpy(), return_inverse=True)
    return rows["f"][0].as_py(), labels, _Cells.of(rows["lo"].to_numpy(), rows["hi"].to_numpy(), label,
                                                   rows["n"].to_numpy(), len(labels))


def best_split(train: DataFrame, label_col: str, feature_cols: list[str], max_bins: int = 32,
               cells: int = CELLS) -> DataFrame:
    """Best gini split of the whole table: ``feature_idx, feature, threshold, gain``.

    At most ``max_bins - 1`` thresholds of each feature are tried, the bounds of the
    cells that are left of it.  Ties go to the lowest feature index, then the
    lowest threshold.  Left is ``x <= threshold``.  Returns no row when no split
    has positive gain.
    """
    cells = max(cells, max_bins)
    prepared = project_configured(train, feature_cols, id_col=None, label_col=label_col)

    def merge(rows: pa.Table) -> pa.Table:
        f, labels, have = _group(rows)
        return pa.Table.from_batches([have.shrunk(cells).rows(f, labels)])

    def split(rows: pa.Table) -> pa.Table:
        f, _, have = _group(rows)
        have = have.shrunk(max_bins)
        left = np.cumsum(have.n, axis=0)[:-1]
        total = have.n.sum(axis=0)
        right = total - left
        nl, nr, n = left.sum(axis=1), right.sum(axis=1), total.sum()

        def gini(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
            return 1 - (counts * counts).sum(axis=-1) / (of * of)

        gain = gini(total, n) - nl / n * gini(left, nl) - nr / n * gini(right, nr)
        threshold = (have.hi[:-1] + np.maximum(have.lo[1:], have.hi[:-1])) / 2
        # the first of equal gains, which can differ in the last bits
        i = int(np.argmax(np.round(gain, 12))) if len(gain) else None
        return pa.table({"f": pa.array([f], pa.int32()), "threshold": pa.array([threshold[i] if len(gain) else None], pa.float64()),
                         "gain": pa.array([gain[i] if len(gain) else 0.0], pa.float64())})

    slices = _summaries(prepared, feature_cols, cells).groupBy("f", F.pmod(F.hash("hi"), F.lit(SLICES))).applyInArrow(
        merge, _SUMMARY)
    found = slices.groupBy("f").applyInArrow(split, "f int, threshold double, gain double").collect()      # a row per feature
    if not found:
        raise ValueError("empty training table")
    best = [(r.f, feature_cols[r.f], r.threshold, r.gain) for r in found if r.gain > 0]
    best.sort(key=lambda r: (-round(r[3], 12), r[0]))
    return train.sparkSession.createDataFrame(best[:1], "feature_idx int, feature string, threshold double, gain double")


# ---- the fitted tree as a table -------------------------------------------------

NODES = "node long, parent long, depth int, feature_idx int, feature string, threshold double, label double, gain double"


def node_table(fit: TreeFit, spark: SparkSession) -> DataFrame:
    """The tree as rows: ``node`` 1 is the root, ``2 n`` and ``2 n + 1`` are the children of ``n`` for
    ``feature <= threshold`` and above it; a leaf has neither feature nor threshold.

    ``label`` is the original label that most training rows of the node have; ``gain`` is the
    split's.  A tree of depth d has fewer than ``2 ^ (d + 1)`` rows."""
    rows, todo = [], [(1, 0, fit.model._call_java("rootNode"))]
    while todo:
        number, depth, node = todo.pop()
        label = fit.labels.values[int(node.prediction())]
        parent = number // 2 or None
        if node.subtreeDepth():
            split = node.split()
            f = split.featureIndex()
            rows.append((number, parent, depth, f, fit.feature_cols[f], split.threshold(), label, node.gain()))
            todo += [(2 * number, depth + 1, node.leftChild()), (2 * number + 1, depth + 1, node.rightChild())]
        else:
            rows.append((number, parent, depth, None, None, None, label, None))
    return spark.createDataFrame(sorted(rows), NODES)


def walk(nodes: DataFrame, df: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
    """``df`` with the leaf that each row ends in and the leaf's label, by ``node_table`` alone.

    One step per level: the row's node looks up its test (a broadcast of the nodes
    of that level) and the row goes on to a child, or stays in its leaf."""
    at, value = "_at", "_value"
    out = df.withColumn(at, F.lit(1).cast("long"))
    depth = nodes.agg(F.max("depth")).first()[0]
    tests = nodes.where("feature IS NOT NULL").select(F.col("node").alias("_n"), "depth", F.col("feature").alias("_f"),
                                                      F.col("threshold").alias("_t"))
    names = [r[0] for r in tests.select("_f").distinct().collect()]                # at most the features of the tree
    for level in range(depth or 0):
        step = out.join(F.broadcast(tests.where(F.col("depth") == level).drop("depth")), F.col(at) == F.col("_n"), "left")
        test = F.coalesce(*[F.when(F.col("_f") == c, F.col(quoted(c))) for c in names])
        step = step.withColumn(value, test)
        after = 2 * F.col(at) + (F.col(value) > F.col("_t")).cast("long")
        out = step.withColumn(at, F.when(F.col("_n").isNull(), F.col(at)).otherwise(after)).drop("_n", "_f", "_t", value)
    leaves = nodes.where("feature IS NULL").select(F.col("node").alias(at), F.col("label").alias("_label"))
    out = out.join(F.broadcast(leaves), at)
    return out.select(*[F.col(quoted(c)) for c in df.columns], F.col(at).alias(node), F.col("_label").alias(label))
