"""k-means: fit, assign, canonical cluster ids, nearest given centre.

Fitting is ``spark.ml.clustering.KMeans`` (k-means|| seeding, Lloyd
iterations as distributed aggregates) over a persisted, assembled frame.
Assignment to a fitted model is its transform; assignment to given centres is
one numpy distance per Arrow batch.  The nearest centre wins, ties go to the
lowest index.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.casting import assemble
from minekit.functions.text import vector_literal_text
from minekit.operators.frames import FEATURES, ID, PREDICTION, flat_result, project_configured

#: Distances computed at a time (8 bytes each), whatever the number of centres.
CELLS = 2_000_000


def fit_kmeans(df: DataFrame, feature_cols: list[str], k: int, max_iter: int = 20,
               seed: int | None = None, id_col: str | None = "id") -> KMeansModel:
    prepared = assemble(project_configured(df, feature_cols, id_col=id_col, id_alias=ID), feature_cols, FEATURES)
    cached = prepared.select(FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        km = KMeans(k=k, maxIter=max_iter, featuresCol=FEATURES, predictionCol=PREDICTION)
        if seed is not None:
            km.setSeed(seed)
        return km.fit(cached)
    finally:
        cached.unpersist()


def assign(model: KMeansModel, df: DataFrame, feature_cols: list[str], id_col: str | None = "id",
           id_alias: str = "id", id_type: str = "int", cluster_col: str = "cluster") -> DataFrame:
    """Strict features + ``cluster_col`` (int index of the model's centre)."""
    prepared = project_configured(df, feature_cols, id_col=id_col, id_alias=id_alias, id_type=id_type)
    m = model.copy()
    m.setFeaturesCol(FEATURES).setPredictionCol(cluster_col)
    return m.transform(assemble(prepared, feature_cols, FEATURES)).drop(FEATURES)


def canonical_ids(assigned: DataFrame, cluster_col: str, key_col: str) -> DataFrame:
    """Replace a cluster index by the smallest key in that cluster.

    Cluster numbers depend on seeding; the smallest member key does not.  The
    lookup has one row per cluster; Spark picks the join from its size.
    """
    ids = assigned.groupBy(cluster_col).agg(F.min(key_col).alias("_cluster_key"))
    return (assigned.join(ids, cluster_col)
            .withColumn(cluster_col, F.col("_cluster_key")).drop("_cluster_key"))


def predict_kmeans(model: KMeansModel, df: DataFrame, feature_cols: list[str], result_label: str = "label",
                   result_features: list[str] | None = None, canonical: bool = False,
                   id_type: str = "int") -> DataFrame:
    """``id, <label> double (cluster), <feature_i> double``."""
    assigned = assign(model, df, feature_cols, id_alias=ID, id_type=id_type, cluster_col=PREDICTION)
    if canonical:
        assigned = canonical_ids(assigned, PREDICTION, ID)
    return flat_result(assigned, F.col(PREDICTION), feature_cols, result_label,
                       result_features or feature_cols, id_col=ID)


def nearest_centre(features: list[Column] | Column, centres) -> Column:
    """Index of the nearest given centre (squared Euclidean), ties to the lowest index.

    ``features`` are columns, or one array column.  Each Arrow batch is
    compared with all centres in numpy, one dimension after the other, over at
    most ``CELLS`` distances at a time; Spark ships the centre matrix to the
    workers once.  A point of another length, or with a NULL, has no centre.
    """
    matrix = np.asarray(centres, dtype=float)
    if not len(matrix):
        raise ValueError("no centres")
    if matrix.ndim != 2 or not isinstance(features, Column) and len(features) != matrix.shape[1]:
        raise ValueError("centre dimension does not match the feature count")
    k, d = matrix.shape
    point = features if isinstance(features, Column) else F.array(*[f.cast("double") for f in features])

    @F.pandas_udf("int")
    def nearest(points: pd.Series) -> pd.Series:
        out = np.full(len(points), -1)
        good = np.flatnonzero([p is not None and len(p) == d for p in points])
        step = max(1, CELLS // k)
        for lo in range(0, len(good), step):
            at = good[lo:lo + step]
            x = np.stack([np.asarray(p, dtype=float) for p in points.iloc[at]])
            dist = np.zeros((len(at), k))
            for j in range(d):
                dist += (x[:, j, None] - matrix[:, j]) ** 2
            out[at] = np.where(np.isnan(x).any(axis=1), -1, dist.argmin(axis=1))
        return pd.Series(out).astype("Int32").mask(out < 0)

    return nearest(point.cast("array<double>"))


def assignment_text(features: list[Column], cluster: Column) -> Column:
    """``[f1,f2,...]==>cluster`` as the reference prints an assignment."""
    return F.concat(vector_literal_text(features), F.lit("==>"), cluster.cast("string"))
