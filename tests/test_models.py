"""Model operators: label handling, planted answers, parity with pyspark.mllib."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import bayes, cluster, fpm, regression, tree
from minekit.operators.frames import train_test_split
from minekit.plans import catalog

SF = "/root/testdata/sf0.001"


def _labelled(spark, labels):
    rows = [(i, float(labels[i % len(labels)]), float(i % 3 + (i % len(labels)) * 5), float(i % 5))
            for i in range(60)]
    return spark.createDataFrame(rows, "id int, y double, a double, b double")


@pytest.mark.parametrize("labels", [(5, 7), (-1, 1), (0.5, 1.5)])
def test_naive_bayes_returns_original_labels(spark, labels):
    df = _labelled(spark, labels)
    fit = bayes.fit_naive_bayes(df, "y", ["a", "b"])
    out = bayes.predict_naive_bayes(fit, df, ["a", "b"], "pred")
    assert {r[0] for r in out.select("pred").distinct().collect()} <= {float(v) for v in labels}
    assert fit.labels.values == tuple(sorted(float(v) for v in labels))


def test_tree_returns_original_labels(spark):
    df = _labelled(spark, (5, 7))
    fit = tree.fit_decision_tree(df, "y", ["a", "b"], max_depth=3)
    acc = bayes.accuracy(tree.score(fit, df.select("y", "a", "b"), ["a", "b"]), "prediction", "y").first()
    assert acc["accuracy"] == 1.0


def test_naive_bayes_rejects_negative_feature(spark):
    df = spark.createDataFrame([(1.0, -1.0), (0.0, 2.0)], "y double, a double")
    with pytest.raises(Exception):
        bayes.fit_naive_bayes(df, "y", ["a"])


def test_naive_bayes_matches_mllib(spark):
    from pyspark.mllib.classification import NaiveBayes as MLlibNB
    from pyspark.mllib.regression import LabeledPoint

    ev = catalog.event_table(spark, SF).where("split = 'train'")
    fit = bayes.fit_naive_bayes(ev, "y", catalog.EVENT_FEATURES)
    pts = ev.select("y", *catalog.EVENT_FEATURES).rdd.map(lambda r: LabeledPoint(r[0], list(r[1:])))
    ref = MLlibNB.train(pts, 1.0)
    assert np.allclose(fit.model.pi.toArray(), ref.pi, atol=1e-12)
    assert np.allclose(fit.model.theta.toArray(), np.array(ref.theta), atol=1e-12)


def test_naive_bayes_save_load(spark, tmp_dir):
    ev = catalog.event_table(spark, SF)
    fit = bayes.fit_naive_bayes(ev.where("split = 'train'"), "y", catalog.EVENT_FEATURES)
    fit.save(tmp_dir + "/m")
    loaded = bayes.NaiveBayesFit.load(spark, tmp_dir + "/m")
    a = bayes.predict_naive_bayes(fit, ev, catalog.EVENT_FEATURES).collect()
    b = bayes.predict_naive_bayes(loaded, ev, catalog.EVENT_FEATURES).collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("reg,cls,kw", [("none", "LinearRegressionWithSGD", {"step": 0.5}),
                                        ("l2", "RidgeRegressionWithSGD", {"step": 1.0}),
                                        ("l1", "LassoWithSGD", {"step": 1.0})])
def test_sgd_matches_mllib(spark, reg, cls, kw):
    import pyspark.mllib.regression as mr

    data = catalog.lineitem_regression(spark, SF)
    fit = regression.fit_sgd(data, "y", ["x1", "x2"], iterations=100, reg=reg, **kw)
    pts = data.rdd.map(lambda r: mr.LabeledPoint(r["y"], [r["x1"], r["x2"]]))
    ref = getattr(mr, cls).train(pts, iterations=100, step=kw["step"], miniBatchFraction=1.0,
                                 intercept=False, **({"regParam": 0.01} if reg != "none" else {}))
    assert np.allclose(fit.weights, ref.weights.toArray(), atol=1e-9)


def test_sgd_divergence_raises(spark):
    df = spark.createDataFrame([(float(i) * 1000, float(i) * 1000) for i in range(1, 50)], "y double, x double")
    with pytest.raises(ArithmeticError):
        regression.fit_sgd(df, "y", ["x"], iterations=50, step=1.0)


def test_tree_recovers_planted_rule(spark):
    po = catalog.planted_orders(spark, SF)
    train, test = train_test_split(po, "id")
    fit = tree.fit_decision_tree(train, "y", ["f1", "f2"], max_depth=3)
    held_out = tree.score(fit, test.select("y", "f1", "f2"), ["f1", "f2"])
    assert held_out.where("prediction != y").count() == 0


def test_best_split_brute_force(spark):
    rows = [(float(i % 4), float((i * 7) % 5), float(i % 4 >= 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    best = tree.best_split(df, "y", ["a", "b"]).first()
    # brute force over midpoints
    def gini(ys):
        n = len(ys)
        return 1 - sum((ys.count(c) / n) ** 2 for c in set(ys)) if n else 0

    ys = [r[2] for r in rows]
    cands = []
    for j in range(2):
        vals = sorted({r[j] for r in rows})
        for lo, hi in zip(vals, vals[1:]):
            t = (lo + hi) / 2
            left = [r[2] for r in rows if r[j] <= t]
            right = [r[2] for r in rows if r[j] > t]
            g = gini(ys) - len(left) / 40 * gini(left) - len(right) / 40 * gini(right)
            cands.append((-round(g, 12), j, t))
    _, j, t = min(cands)
    assert (best["feature_idx"], best["threshold"]) == (j, t)


def test_best_split_high_cardinality_is_bounded(spark):
    rows = [(float(i), float(i > 500)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, y double")
    best = tree.best_split(df, "y", ["a"], max_bins=32).first()
    assert best["feature_idx"] == 0 and 400 <= best["threshold"] <= 600


def test_kmeans_planted_groups(spark):
    for seed in (1, 2, 3):
        pts = catalog.customer_points(spark, SF)
        model = cluster.fit_kmeans(pts, ["f1", "f2"], k=3, max_iter=20, seed=seed)
        out = cluster.predict_kmeans(model, pts, ["f1", "f2"], "c", canonical=True)
        groups = out.groupBy("c").agg(F.countDistinct("f2").alias("n")).collect()
        assert len(groups) == 3 and all(g["n"] == 1 for g in groups)


def test_nearest_centre_ties_to_lowest(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    idx = cluster.nearest_centre([F.col("x")], [[1.5], [0.5], [1.5]])
    assert [r[0] for r in df.select(idx).collect()] == [1, 0, 0]


def test_fpgrowth_matches_mllib(spark):
    from pyspark.mllib.fpm import FPGrowth as MLlibFP

    bk = fpm.baskets(catalog.order_baskets(spark, SF, "p_type"), "basket")
    model = fpm.fit_fpgrowth(bk, 0.05, 0.3)
    ours = {(r["itemset"], r["freq"]) for r in fpm.freq_itemsets(model).collect()}
    ref = MLlibFP.train(bk.rdd.map(lambda r: r["items"]), minSupport=0.05, numPartitions=4)
    theirs = {(" ".join(sorted(fi.items)), fi.freq) for fi in ref.freqItemsets().collect()}
    assert ours == theirs


def test_basket_duplicates(spark):
    df = spark.createDataFrame([("a b a",)], "basket string")
    with pytest.raises(Exception):
        fpm.baskets(df, "basket").collect()
    assert sorted(fpm.baskets(df, "basket", dedupe=True).first()["items"]) == ["a", "b"]


def test_rule_text_format(spark):
    df = spark.createDataFrame([("b a",), ("a b",), ("a",)], "basket string")
    model = fpm.fit_fpgrowth(fpm.baskets(df, "basket"), 0.5, 0.5)
    rules = {r["rule"]: r["confidence"] for r in fpm.rule_text(model).collect()}
    assert rules == {"[a] => [b]": 2 / 3, "[b] => [a]": 1.0}


def test_tree_predictions_match_mllib(spark):
    from pyspark.mllib.regression import LabeledPoint
    from pyspark.mllib.tree import DecisionTree

    ev = catalog.event_table(spark, SF)
    fit = tree.fit_decision_tree(ev, "y", catalog.EVENT_FEATURES, max_depth=4, max_bins=32)
    ours = {r["id"]: r["label"] for r in tree.predict_decision_tree(fit, ev, catalog.EVENT_FEATURES).collect()}
    rows = ev.select("id", "y", *catalog.EVENT_FEATURES).collect()
    pts = spark.sparkContext.parallelize([LabeledPoint(r["y"], [r["hour"], r["k"], r["value"]]) for r in rows], 4)
    ref = DecisionTree.trainClassifier(pts, numClasses=5, categoricalFeaturesInfo={}, impurity="gini",
                                       maxDepth=4, maxBins=32)
    theirs = ref.predict(spark.sparkContext.parallelize([[r["hour"], r["k"], r["value"]] for r in rows], 4)).collect()
    assert [ours[r["id"]] for r in rows] == theirs


def test_als_key_set_matches_mllib(spark):
    from pyspark.mllib.recommendation import ALS as MLlibALS

    from minekit.operators import als
    ratings = catalog.cust_supp_ratings(spark, SF)
    train = ratings.where(catalog.als_train_flag())
    model = als.fit_als(train, rank=4, max_iter=3, seed=7)
    ours = {(r[0], r[1]) for r in als.predict_pairs(model, ratings).collect()}
    ref = MLlibALS.train(train.rdd.map(lambda r: (r[0], r[1], r[2])), rank=4, iterations=3, lambda_=0.01, seed=7)
    theirs = {(r.user, r.product) for r in ref.predictAll(ratings.rdd.map(lambda r: (r[0], r[1]))).collect()}
    assert ours == theirs


def test_tree_debug_string_shows_original_labels(spark):
    df = _labelled(spark, (5, 7))
    text = tree.fit_decision_tree(df, "y", ["a", "b"], max_depth=2).debug_string()
    preds = set(re.findall(r"Predict: ([0-9.]+)", text))
    assert preds and preds <= {"5.0", "7.0"}


def test_naive_bayes_scoring_rejects_negative_feature(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 0.0, 3.0)], "id int, y double, a double")
    fit = bayes.fit_naive_bayes(df, "y", ["a"])
    bad = spark.createDataFrame([(3, -1.0)], "id int, a double")
    with pytest.raises(Exception):
        bayes.predict_naive_bayes(fit, bad, ["a"]).collect()


def test_sgd_solvers_agree_and_fail_alike(spark):
    data = catalog.lineitem_regression(spark, SF)
    gram = regression.fit_sgd(data, "y", ["x1", "x2"], iterations=100, step=0.5)
    it = regression.fit_sgd(data, "y", ["x1", "x2"], iterations=100, step=0.5, solver="iterative")
    assert it.iterations == gram.iterations
    assert np.allclose(it.weights, gram.weights, atol=1e-12)
    for solver in ("gram", "iterative"):
        with pytest.raises(ValueError, match="empty training table"):
            regression.fit_sgd(data.limit(0), "y", ["x1", "x2"], solver=solver)
    with pytest.raises(ValueError, match="unknown solver"):
        regression.fit_sgd(data, "y", ["x1", "x2"], solver="exact")


@pytest.mark.parametrize("tile,chunk", [(512, 64 << 20), (8, 64 << 20), (7, 8 * 25 * 100), (1, 8 * 25)])
def test_gram_sums(spark, monkeypatch, tile, chunk):
    monkeypatch.setattr(regression, "TILE", tile)
    monkeypatch.setattr(regression, "CHUNK_BYTES", chunk)
    wide = spark.range(3000).select(*[((F.col("id") * (i + 3)) % 17 / 17.0).alias(f"x{i}") for i in range(24)],
                                    ((F.col("id") % 11) / 11.0).alias("y"))
    cols = [f"x{i}" for i in range(24)]
    g = regression.gram(wide, "y", cols)
    pdf = wide.toPandas()
    x = pdf[cols].to_numpy()
    assert g.n == 3000
    assert np.allclose(g.xx, x.T @ x, rtol=1e-12) and np.allclose(g.xy, x.T @ pdf["y"].to_numpy(), rtol=1e-12)


def test_weights_of_a_table_of_several_tiles(spark):
    d, n = 1100, 400
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, d)) / np.sqrt(d)
    y = x @ rng.normal(size=d)
    names = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame([(float(b), a.tolist()) for a, b in zip(x, y)], "y double, v array<double>")
    df = df.select("y", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)])
    g = regression.gram(df, "y", names)
    assert g.n == n
    assert np.allclose(g.xx, x.T @ x, atol=1e-12) and np.allclose(g.xy, x.T @ y, atol=1e-12)


def test_wide_regression_scores(spark):
    d = 2500
    names = [f"x{i}" for i in range(d)]
    df = spark.range(5).select("id", *[((F.col("id") + i) % 7).cast("double").alias(c) for i, c in enumerate(names)])
    weights = np.linspace(-1, 1, d)
    out = regression.predict_sgd(regression.SgdFit(weights, 1, names), df, names)
    got = {r["id"]: r["label"] for r in out.select("id", "label").collect()}
    for i in range(5):
        assert abs(got[i] - sum(w * ((i + j) % 7) for j, w in enumerate(weights))) < 1e-9


def test_many_classes(spark):
    rows = [(i, float(i % 500) * 3, float(i % 500), float(500 - i % 500)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, y double, a double, b double")
    fit = bayes.fit_naive_bayes(df, "y", ["a", "b"])
    assert fit.labels.num_classes == 500
    labels = {r["label"] for r in bayes.predict_naive_bayes(fit, df, ["a", "b"]).select("label").distinct().collect()}
    assert len(labels) > 100 and labels <= {float(i) * 3 for i in range(500)}
    with pytest.raises(ValueError, match="more than 10 distinct"):
        bayes.fit_naive_bayes(df, "y", ["a", "b"], max_classes=10)


def test_naive_bayes_given_class_without_rows(spark):
    df = spark.createDataFrame([(i, float(i % 2 * 2), float(i % 2 * 9 + 1), float(9 - i % 2 * 8)) for i in range(20)],
                               "id int, y double, a double, b double")
    fit = bayes.fit_naive_bayes(df, "y", ["a", "b"], labels=[0, 1, 2])
    out = bayes.predict_naive_bayes(fit, df, ["a", "b"]).collect()
    assert {(r["id"] % 2 * 2, r["label"]) for r in out} == {(0, 0.0), (2, 2.0)}
    with pytest.raises(ValueError, match="not among the given classes"):
        bayes.fit_naive_bayes(df, "y", ["a", "b"], labels=[0, 1])


def test_many_centre_values(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20_000, 64))                 # 1.28 million numbers
    rows = [(i, centres[i * 37].tolist()) for i in range(300)] + [(300, None), (301, [1.0]), (302, [None] * 64)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    got = {r["id"]: r["c"] for r in df.select("id", cluster.nearest_centre(F.col("x"), centres).alias("c")).collect()}
    assert all(got[i] == i * 37 for i in range(300)) and got[300] is got[301] is got[302] is None


def test_nearest_centre_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = np.vstack([rng.uniform(0, 10, size=(80, 2)), [[5.0, 5.0], [5.0, 5.0]]])
    points = np.vstack([rng.uniform(0, 10, size=(300, 2)), [[5.0, 5.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    got = {r["i"]: r["c"] for r in df.select("i", cluster.nearest_centre([F.col("x"), F.col("y")], centres).alias("c")).collect()}
    want = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert [got[i] for i in range(301)] == want.tolist() and got[300] == 80


def test_null_basket_raises(spark):
    df = spark.createDataFrame([("a b",), (None,)], "basket string")
    for dedupe in (False, True):
        with pytest.raises(Exception, match="NULL basket"):
            fpm.baskets(df, "basket", dedupe=dedupe).collect()


def test_als_depends_on_blocks_not_on_partitions(spark):
    from minekit.operators import als
    ratings = catalog.cust_supp_ratings(spark, SF).where("user < 40").orderBy("user", "item")
    rows = [tuple(r) for r in ratings.collect()]

    def predictions(parts):
        df = spark.createDataFrame(rows, ratings.schema).repartition(parts)
        model = als.fit_als(df, rank=3, max_iter=3, seed=7)
        return {(r[0], r[1]): r[2] for r in als.predict_pairs(model, df).collect()}

    a, b = predictions(2), predictions(9)
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-3


def test_best_split_many_values_and_empty_table(spark):
    # 50 values, more than max_bins but counted one by one
    df = spark.createDataFrame([(float(i % 50), float(i % 50 >= 25)) for i in range(500)], "a double, y double")
    best = tree.best_split(df, "y", ["a"], max_bins=32).first()
    assert best["gain"] > 0.4 and 23 <= best["threshold"] <= 26
    with pytest.raises(ValueError, match="empty training table"):
        tree.best_split(df.limit(0), "y", ["a"])
