"""The root split from mergeable summaries, and the tree as a table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import tree
from minekit.plans import catalog, jobs
from tests.conftest import SF_SMALL


def _planted(spark, values, cut, noise=False):
    """Rows x in 0 .. values - 1, label by a cut, in no order."""
    x = F.pmod(F.col("id") * 7919, F.lit(values)).cast("double")
    y = (x > cut).cast("double")
    if noise:
        y = F.when(F.pmod(F.hash("id"), F.lit(10)) == 3, 1 - y).otherwise(y)
    return spark.range(max(4 * values, 2000)).select(x.alias("x"), F.pmod(F.col("id"), F.lit(6)).cast("double").alias("z"),
                                                     y.alias("y")).repartition(9)


@pytest.mark.parametrize("values", [2, 20, 50, 10_000])
def test_planted_split_is_found_whatever_the_number_of_values(spark, values):
    cut = values * 2 // 5
    row = tree.best_split(_planted(spark, values, cut), "y", ["z", "x"]).collect()[0]
    assert (row.feature, row.threshold) == ("x", cut + 0.5)


@pytest.mark.parametrize("values", [20, 50, 10_000])
def test_noisy_split_is_found_closely(spark, values):
    cut = values * 2 // 5
    row = tree.best_split(_planted(spark, values, cut, noise=True), "y", ["z", "x"]).collect()[0]
    assert row.feature == "x" and abs(row.threshold - cut - 0.5) <= values / 32


def test_one_scan_of_the_table(spark, tmp_dir):
    _planted(spark, 50, 20).write.parquet(f"{tmp_dir}/t")
    prepared = tree.project_configured(spark.read.parquet(f"{tmp_dir}/t"), ["x", "z"], id_col=None, label_col="y")
    plan = tree._summaries(prepared, ["x", "z"], 64)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("MapInArrow") == 1 and "partial_sum" in plan


def test_no_split(spark):
    one = spark.createDataFrame([(1.0, 1.0, 0.0), (1.0, 1.0, 1.0)], "a double, b double, y double")
    assert tree.best_split(one, "y", ["a", "b"]).count() == 0
    with pytest.raises(ValueError, match="empty training table"):
        tree.best_split(one.limit(0), "y", ["a"])


def _cells(x, y):
    return tree._Cells.of(x, x, y, np.ones(len(x)), int(y.max()) + 1)


def test_summaries_merge_in_any_parts():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 40, 3000).astype(float), rng.integers(0, 3, 3000)
    whole = _cells(x, y)
    parts = _cells(x[:700], y[:700]).plus(_cells(x[700:], y[700:]))
    assert (whole.n == parts.n).all() and (whole.hi == parts.hi).all() and (whole.lo == parts.lo).all()
    small = whole.shrunk(10)
    assert len(small.hi) == 10 and small.n.sum() == 3000 and (small.lo[1:] > small.hi[:-1]).all()


def test_shrinking_keeps_the_bounds_of_pure_stretches():
    x = np.arange(5000.0)
    y = np.digitize(x, [100, 101, 2500, 4999]) % 2
    small = _cells(x, y).shrunk(5)
    assert small.hi.tolist() == [99.0, 100.0, 2499.0, 4998.0, 4999.0]
    again = _cells(x[::2], y[::2]).shrunk(64).plus(_cells(x[1::2], y[1::2]).shrunk(64)).shrunk(5)
    assert again.n.sum() == 5000


def test_equal_cells_shrink_evenly():
    x = np.arange(4096.0)
    small = _cells(x, np.zeros(4096, dtype=int)).shrunk(32)
    assert len(small.hi) == 32 and small.n.sum(axis=1).max() <= 4 * 128


def test_walk_equals_predict(spark):
    ev = catalog.event_table(spark, SF_SMALL).select("id", "y", "hour", "k", F.col("value").alias("the value"))
    features = ["hour", "k", "the value"]
    fit = tree.fit_decision_tree(ev, "y", features, max_depth=6)
    nodes = tree.node_table(fit, spark)
    rows = {r.node: r for r in nodes.collect()}
    assert len(rows) == fit.model.numNodes and max(r.depth for r in rows.values()) == fit.model.depth
    assert all(r.parent is None if n == 1 else r.parent == n // 2 for n, r in rows.items())
    assert all((2 * n in rows) == (r.feature is not None) for n, r in rows.items())
    walked = {r.id: r.found for r in tree.walk(nodes, ev, "leaf", "found").collect()}
    said = {r.id: r.label for r in tree.predict_decision_tree(fit, ev, features, "label", ["a", "b", "c"]).collect()}
    assert walked == said and len(said) == ev.count()


def test_tree_of_one_leaf(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 2.0, 7.0)], "id int, x double, y double")
    fit = tree.fit_decision_tree(df, "y", ["x"])
    nodes = tree.node_table(fit, spark)
    assert [(r.node, r.feature, r.label) for r in nodes.collect()] == [(1, None, 7.0)]
    assert {(r.id, r.node, r.label) for r in tree.walk(nodes, df.select("id", "x")).collect()} == {(1, 1, 7.0), (2, 1, 7.0)}


def test_job_writes_the_rules(spark, tmp_dir):
    po = catalog.planted_orders(spark, SF_SMALL)
    po.write.parquet(f"{tmp_dir}/t")
    spec = {"datasource": {"train_table": {"path": f"{tmp_dir}/t"}, "test_table": {"path": f"{tmp_dir}/t"}},
            "output": {"result_table": {"path": f"{tmp_dir}/r"}, "rules_table": {"path": f"{tmp_dir}/rules"}},
            "operational_param": {"train_label_col": "y", "train_feture_col": "f1 f2", "test_feture_col": "f1 f2",
                                  "result_label_col": "label", "result_feture_col": "f1 f2", "numClasses": 3, "maxDepth": 3,
                                  "maxBins": 32}}
    for _ in range(2):
        jobs.decision_tree(spark, spec)
    got = spark.read.parquet(f"{tmp_dir}/rules").orderBy("node").collect()
    assert [(r.node, r.feature, r.threshold) for r in got] == [(1, "f1", 3.5), (2, None, None), (3, "f2", 5.5), (6, None, None),
                                                               (7, None, None)]
