"""The composite, spec-driven jobs: read -> operator -> flat result -> write.

Each job checks the whole spec (column counts, numbers) before any Spark
job starts, reads only the configured columns, trains, scores lazily and
writes once.  The returned DataFrame is the result; pass ``write=False``
to get it without touching the result table.

Write modes follow the reference: append everywhere except k-means,
which overwrites; text results refuse an existing target.  A result table with
a ``run_id`` gets the rows of that run once, however often the job is run.

Scored tables must have an integral ``id``: 32-bit in the result, or 64-bit
with ``"id_type": "bigint"`` in the spec.  A JDBC read of such a table is
split by ``id``, one of a training table by a hash of its configured columns,
unless the source says how (``minekit.sources.tables``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.functions.text import java_split, parse_values
from minekit.operators import als, bayes, cluster, fpm, regression, tree
from minekit.operators.frames import check_counts, preview as top_rows
from minekit.plans.spec import JobSpec
from minekit.sources import text as text_io
from minekit.sources.tables import read_table, write_table


class TreeResult(NamedTuple):
    result: DataFrame
    rules: str                  # the fitted tree, with the original labels


class RegressionResult(NamedTuple):
    result: DataFrame
    mse: DataFrame              # one row: mean squared error on the training rows, and their number


class RatingResult(NamedTuple):
    result: DataFrame
    ratings: DataFrame          # training ratings next to their predictions
    mse: DataFrame              # one row over ``ratings``


def _id_type(s: JobSpec) -> str:
    kind = s.text("id_type", "int").lower()
    if kind not in ("int", "bigint"):
        raise ValueError(f"operational_param.id_type must be int or bigint, not {kind!r}")
    return kind


def _scored_table(spark: SparkSession, s: JobSpec, which: str) -> DataFrame:
    return read_table(spark, s.table(which), partition_column="id")


def _train_table(spark: SparkSession, s: JobSpec, columns: list[str]) -> DataFrame:
    return read_table(spark, s.table("train_table"), split_columns=columns)


def _finish(result: DataFrame, spec: JobSpec, mode: str, write: bool) -> DataFrame:
    if write and spec.result_table:
        write_table(result, spec.result_table, mode)
    return result


def _supervised_columns(s: JobSpec):
    label = s.text("train_label_col")
    tf = s.columns("train_feture_col")
    xf = s.columns("test_feture_col")
    rl = s.text("result_label_col")
    rf = s.columns("result_feture_col")
    check_counts(tf, xf, rf)
    return label, tf, xf, rl, rf


def naive_bayes(spark: SparkSession, spec, write: bool = True) -> DataFrame:
    """Multinomial naive Bayes: train table -> model -> scored test table."""
    s = JobSpec.parse(spec)
    label, tf, xf, rl, rf = _supervised_columns(s)
    smoothing, id_type = s.number("smoothing", 1.0), _id_type(s)
    train, test = _train_table(spark, s, [label, *tf]), _scored_table(spark, s, "test_table")
    fit = bayes.fit_naive_bayes(train.select(label, *tf), label, tf, smoothing=smoothing)
    result = bayes.predict_naive_bayes(fit, test, xf, rl, rf, id_type=id_type)
    return _finish(result, s, "append", write)


def naive_bayes_fixed_layout(spark: SparkSession, spec, write: bool = True) -> DataFrame:
    """The positional variant: no column names in the spec."""
    s = JobSpec.parse(spec)
    train, test = read_table(spark, s.table("train_table")), read_table(spark, s.table("test_table"))
    return _finish(bayes.naive_bayes_positional(train, test), s, "append", write)


def decision_tree(spark: SparkSession, spec, write: bool = True) -> TreeResult:
    """Gini decision tree: ``numClasses``, ``maxDepth``, ``maxBins``.  Returns the
    scored table and the tree's rules; a ``rules_table`` beside the result table gets
    them as rows (``tree.node_table``), replacing what it held."""
    s = JobSpec.parse(spec)
    label, tf, xf, rl, rf = _supervised_columns(s)
    num_classes, depth, bins = s.integer("numClasses"), s.integer("maxDepth"), s.integer("maxBins")
    seed = s.integer("seed", 0) if s.text("seed", "") else None
    id_type = _id_type(s)
    train, test = _train_table(spark, s, [label, *tf]), _scored_table(spark, s, "test_table")
    fit = tree.fit_decision_tree(train.select(label, *tf), label, tf, max_depth=depth, max_bins=bins,
                                 num_classes=num_classes, seed=seed)
    result = tree.predict_decision_tree(fit, test, xf, rl, rf, id_type=id_type)
    if write and s.rules_table:
        write_table(tree.node_table(fit, spark), s.rules_table, "overwrite")
    return TreeResult(_finish(result, s, "append", write), fit.debug_string())


def linear_regression(spark: SparkSession, spec, write: bool = True) -> RegressionResult:
    """SGD regression, no intercept: ``stepSize``, ``iterateNum``; optional
    ``regularizer`` (none / l2 / l1) and ``regParam`` for ridge and lasso, and
    ``solver`` (gram / iterative).  Returns the scored table and the mean squared
    error on the training rows."""
    s = JobSpec.parse(spec)
    label, tf, xf, rl, rf = _supervised_columns(s)
    step, iters = s.number("stepSize"), s.integer("iterateNum")
    reg, reg_param = s.text("regularizer", "none"), s.number("regParam", 0.01)
    solver, id_type = s.text("solver", "gram"), _id_type(s)
    train, test = _train_table(spark, s, [label, *tf]), _scored_table(spark, s, "test_table")
    fit = regression.fit_sgd(train.select(label, *tf), label, tf, iterations=iters, step=step,
                             reg=reg, reg_param=reg_param, solver=solver)
    result = regression.predict_sgd(fit, test, xf, rl, rf, id_type=id_type)
    return RegressionResult(_finish(result, s, "append", write), regression.mse(fit, train, label, tf))


def kmeans(spark: SparkSession, spec, write: bool = True) -> DataFrame:
    """k-means on the train table, which it also scores; overwrites the result.

    ``clusterNum``, ``iterateNum``; optional ``seed`` and
    ``canonical_ids`` (cluster = smallest id in it instead of 0..k-1).
    """
    s = JobSpec.parse(spec)
    tf = s.columns("train_feture_col")
    rl, rf = s.text("result_label_col"), s.columns("result_feture_col")
    check_counts(tf, None, rf)
    k, iters = s.integer("clusterNum"), s.integer("iterateNum")
    seed = s.integer("seed", 0) if s.text("seed", "") else None
    canonical, id_type = s.text("canonical_ids", "false").lower() == "true", _id_type(s)
    points = _scored_table(spark, s, "train_table").select("id", *[c for c in tf if c != "id"])
    model = cluster.fit_kmeans(points, tf, k=k, max_iter=iters, seed=seed)
    result = cluster.predict_kmeans(model, points, tf, rl, rf, canonical=canonical, id_type=id_type)
    return _finish(result, s, "overwrite", write)


def association_rules(spark: SparkSession, spec, write: bool = True) -> DataFrame:
    """FP-growth rules from a basket column: ``min_support``,
    ``min_confidence``; optional ``num_partitions`` and ``dedupe``."""
    s = JobSpec.parse(spec)
    col = s.text("train_association_col")
    rule_col, conf_col = s.text("result_rule_col"), s.text("result_conf_col")
    support, confidence = s.number("min_support"), s.number("min_confidence")
    parts = s.integer("num_partitions", 0) or None
    dedupe = s.text("dedupe", "false").lower() == "true"
    bk = fpm.baskets(_train_table(spark, s, [col]).select(col), col, dedupe=dedupe)
    model = fpm.fit_fpgrowth(bk, support, confidence, num_partitions=parts)
    return _finish(fpm.rule_text(model, rule_col, conf_col), s, "append", write)


def collaborative_filtering(spark: SparkSession, spec, write: bool = True) -> RatingResult:
    """ALS on (user, item, rating); scores the test pairs it can (known user
    and item).  ``rank``, ``numIterations``; optional ``seed``, ``regParam``,
    ``num_blocks`` and ``key_type`` (``int``, or for other user and item keys ``bigint``
    or ``string``).  Returns the scored pairs, the training ratings next to
    their predictions, and those ratings' mean squared error."""
    s = JobSpec.parse(spec)
    tu, ti, tr = s.text("train_user_col"), s.text("train_item_col"), s.text("train_rate_col")
    xu, xi = s.text("test_user_col"), s.text("test_item_col")
    ru, ri, rr = s.text("result_user_col"), s.text("result_item_col"), s.text("result_rate_col")
    rank, iters = s.integer("rank"), s.integer("numIterations")
    seed = s.integer("seed", 0) if s.text("seed", "") else None
    reg, blocks = s.number("regParam", 0.01), s.integer("num_blocks", als.NUM_BLOCKS)
    kind = s.text("key_type", "int").lower()
    ratings = als.ratings_frame(_train_table(spark, s, [tu, ti]), tu, ti, tr, kind)
    pairs = als.pairs_frame(read_table(spark, s.table("test_table"), split_columns=[xu, xi]), xu, xi, kind)
    fit = als.fit_als if kind == "int" else als.fit_keyed_als
    model = fit(ratings, rank=rank, max_iter=iters, reg_param=reg, seed=seed, num_blocks=blocks)
    result = _finish(als.predict_pairs(model, pairs, ru, ri, rr), s, "append", write)
    both = als.rates_and_preds(model, ratings)
    return RatingResult(result, both, als.rating_mse(both))


def score_text_with_saved_model(spark: SparkSession, model_path: str, input_path: str,
                                output_path: str | None = None, n_features: int = 3) -> DataFrame:
    """Load a saved naive Bayes model, score ``f1 f2 f3`` text lines and
    write ``(line,prediction)`` text (the output folder must not exist)."""
    fit = bayes.NaiveBayesFit.load(spark, model_path)
    names = [f"_x{i}" for i in range(n_features)]
    lines = text_io.read_lines(spark, input_path)
    vals = parse_values(java_split(F.col("value"), " "), n_features, pad=False, what="vector line")
    parsed = lines.select(F.col("value").alias("line"), *[v.alias(n) for v, n in zip(vals, names)])
    scored = bayes.score(fit, parsed, names)
    out = scored.select(text_io.scored_line(F.col("line"), F.col("prediction")).alias("value"))
    if output_path:
        text_io.write_lines(out, output_path)
    return out


def kmeans_text(spark: SparkSession, input_path: str, k: int, iterations: int, n_features: int = 3,
                seed: int | None = None) -> DataFrame:
    """k-means over ``f1 f2 f3`` text lines (short lines padded with 0);
    returns ``[f1,f2,f3]==>cluster`` strings."""
    names = [f"x{i}" for i in range(n_features)]
    lines = text_io.read_lines(spark, input_path)
    vals = parse_values(java_split(F.col("value"), " "), n_features, pad=True, what="vector line")
    points = lines.select(F.monotonically_increasing_id().alias("id"),
                          *[v.alias(n) for v, n in zip(vals, names)])
    model = cluster.fit_kmeans(points, names, k=k, max_iter=iterations, seed=seed, id_col=None)
    assigned = cluster.assign(model, points, names, id_col=None)
    return assigned.select(cluster.assignment_text([F.col(n) for n in names], F.col("cluster"))
                           .alias("assignment"))


def preview(spark: SparkSession, source: dict, key: str, n: int = 20) -> DataFrame:
    """First ``n`` rows of a table by ``key``."""
    return top_rows(read_table(spark, source), key, n)
