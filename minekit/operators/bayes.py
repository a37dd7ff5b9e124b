"""Multinomial naive Bayes (train, score, parameters, accuracy, save/load).

Training is ``spark.ml.NaiveBayes``: one grouped aggregate over the
training rows (partial sums per label map-side, k rows after the shuffle).
Scoring is map-only: the ``spark.ml`` transform, whose model Spark ships to
the executors.  Labels go through ``LabelIndex`` so any double label comes
back unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minekit.functions.casting import assemble, non_negative, quoted, strict_int
from minekit.operators.frames import FEATURES, ID, LABEL, PREDICTION, flat_result, project_configured
from minekit.operators.labels import LabelIndex

CLASS = "_class_idx"


@dataclass
class NaiveBayesFit:
    model: NaiveBayesModel
    labels: LabelIndex
    feature_cols: list[str]

    def save(self, path: str) -> None:
        """Model and label map under one folder (any shared file system)."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        (spark.createDataFrame([(i, v) for i, v in enumerate(self.labels.values)], "idx int, label double")
         .coalesce(1).write.mode("overwrite").json(f"{path}/labels"))
        (spark.createDataFrame([(i, c) for i, c in enumerate(self.feature_cols)], "idx int, name string")
         .coalesce(1).write.mode("overwrite").json(f"{path}/features"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NaiveBayesFit":
        model = NaiveBayesModel.load(f"{path}/model")
        # Both side tables hold one row per class / feature.
        labels = [r["label"] for r in spark.read.json(f"{path}/labels").orderBy("idx").collect()]
        feats = [r["name"] for r in spark.read.json(f"{path}/features").orderBy("idx").collect()]
        return cls(model, LabelIndex(tuple(labels)), feats)


def _nb_features(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    checked = df.select(*[F.col(quoted(c)) for c in df.columns if c not in feature_cols],
                        *[non_negative(F.col(quoted(c)), c) for c in feature_cols])
    return assemble(checked, feature_cols, FEATURES)


def fit_naive_bayes(train: DataFrame, label_col: str, feature_cols: list[str],
                    smoothing: float = 1.0, max_classes: int | None = None,
                    labels: list[float] | None = None) -> NaiveBayesFit:
    """Fit on ``label_col`` and ``feature_cols`` (strictly numeric, >= 0).

    The classes are those that occur in the training rows.  ``labels``: the
    values that may occur; a training label outside the list fails the fit, a
    listed class without rows is no class of the model.
    """
    prepared = project_configured(train, feature_cols, id_col=None, label_col=label_col)
    found = LabelIndex.fit(prepared, F.col(LABEL), max_classes)
    unknown = set(found.values) - {float(v) for v in labels} if labels is not None else set()
    if unknown:
        raise ValueError(f"label not among the given classes: {sorted(unknown)}")
    indexed = found.with_index(prepared, LABEL)
    nb = NaiveBayes(smoothing=smoothing, modelType="multinomial", labelCol=LABEL, featuresCol=FEATURES,
                    predictionCol=PREDICTION, rawPredictionCol="_raw", probabilityCol="_probability")
    model = nb.fit(_nb_features(indexed, feature_cols))
    return NaiveBayesFit(model, found, list(feature_cols))


def score(fit: NaiveBayesFit, prepared: DataFrame, feature_cols: list[str],
          prediction: str = "prediction") -> DataFrame:
    """Add the predicted original label value, as column ``prediction``, to a
    strictly typed frame.

    Test columns match the training columns by position, not by name.
    """
    if len(feature_cols) != len(fit.feature_cols):
        raise ValueError(f"model has {len(fit.feature_cols)} features, got {len(feature_cols)}")
    model = fit.model.copy()
    model.setFeaturesCol(FEATURES).setPredictionCol(CLASS)
    model.setRawPredictionCol("").setProbabilityCol("")
    scored = model.transform(_nb_features(prepared, feature_cols))
    return scored.withColumn(prediction, fit.labels.label(F.col(CLASS))).drop(FEATURES, CLASS)


def predict_naive_bayes(fit: NaiveBayesFit, test: DataFrame, feature_cols: list[str],
                        result_label: str = "label", result_features: list[str] | None = None,
                        id_col: str | None = "id", id_type: str = "int") -> DataFrame:
    """Score a test table: ``id, <label> double, <feature_i> double``."""
    prepared = project_configured(test, feature_cols, id_col=id_col, id_alias=ID, id_type=id_type)
    scored = score(fit, prepared, feature_cols, PREDICTION)
    return flat_result(scored, F.col(PREDICTION), feature_cols, result_label,
                       result_features or feature_cols, id_col=ID if id_col else None)


def naive_bayes_params(spark: SparkSession, fit: NaiveBayesFit) -> DataFrame:
    """One row per (label, feature): log prior ``pi`` and log likelihood ``theta``.

    The k x d parameter matrix is already on the driver inside the model.
    """
    pi = fit.model.pi.toArray()
    theta = fit.model.theta.toArray()
    rows = [(float(fit.labels.values[c]), j, fit.feature_cols[j], float(pi[c]), float(theta[c, j]))
            for c in range(len(pi)) for j in range(theta.shape[1])]
    schema = T.StructType([
        T.StructField("label", T.DoubleType()), T.StructField("feature_idx", T.IntegerType()),
        T.StructField("feature", T.StringType()), T.StructField("pi", T.DoubleType()),
        T.StructField("theta", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def accuracy(scored: DataFrame, prediction: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Share of rows with ``prediction == label`` (one partial aggregate)."""
    hit = F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy")
    n = F.count(F.lit(1)).alias("n")
    return scored.groupBy(*(by or [])).agg(hit, n)


def naive_bayes_positional(train: DataFrame, test: DataFrame, smoothing: float = 1.0,
                           result_names: tuple[str, ...] = ("label", "feture1", "feture2", "feture3")
                           ) -> DataFrame:
    """The fixed-layout variant: columns are taken by position, not name.

    Train: column 0 ignored, integer label at 1, integer features at 2..4.
    Test: columns 0 and 1 ignored, double features at 2..4.  The result has
    no id: ``label, feture1, feture2, feture3``, all double.
    """
    n = len(result_names) - 1
    tc, sc = train.columns, test.columns
    if len(tc) < 2 + n or len(sc) < 2 + n:
        raise ValueError(f"positional layout needs at least {2 + n} columns")
    label, feats = tc[1], tc[2:2 + n]
    names = [f"_p{i}" for i in range(n)]
    typed_train = train.select(strict_int(train, label, "_y").cast("double").alias("_y"),
                               *[strict_int(train, c, a).cast("double").alias(a) for c, a in zip(feats, names)])
    fit = fit_naive_bayes(typed_train, "_y", names, smoothing=smoothing)
    typed_test = test.select(*[F.col(c).alias(a) for c, a in zip(sc[2:2 + n], names)])
    prepared = project_configured(typed_test, names, id_col=None)
    scored = score(fit, prepared, names, PREDICTION)
    return flat_result(scored, F.col(PREDICTION), names, result_names[0], list(result_names[1:]), id_col=None)
