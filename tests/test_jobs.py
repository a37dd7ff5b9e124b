"""Spec-driven jobs end to end on parquet sources and sinks."""

import pytest
from pyspark.sql import functions as F

from minekit.plans import catalog, jobs
from minekit.plans.spec import JobSpec, encode
from minekit.sources.tables import jdbc_options

SF = "/root/testdata/sf0.001"


def _tables(spark, tmp_dir):
    ev = catalog.event_table(spark, SF)
    train = ev.select("y", "hour", "k", "value")
    test = ev.select(F.col("id"), F.col("hour").alias("t1"), F.col("k").alias("t2"), F.col("value").alias("t3"))
    train.write.parquet(f"{tmp_dir}/train")
    test.write.parquet(f"{tmp_dir}/test")
    return test.count()


def _nb_spec(tmp_dir, **params):
    p = {"train_label_col": "y", "train_feture_col": "hour k value", "test_feture_col": "t1 t2 t3",
         "result_label_col": "label", "result_feture_col": "r1 r2 r3"}
    p.update(params)
    return {"datasource": {"train_table": {"path": f"{tmp_dir}/train"},
                           "test_table": {"path": f"{tmp_dir}/test"}},
            "output": {"result_table": {"path": f"{tmp_dir}/result"}},
            "operational_param": p}


def test_naive_bayes_job_appends(spark, tmp_dir):
    n = _tables(spark, tmp_dir)
    spec = encode(_nb_spec(tmp_dir))
    jobs.naive_bayes(spark, spec)
    out = spark.read.parquet(f"{tmp_dir}/result")
    assert out.columns == ["id", "label", "r1", "r2", "r3"]
    assert dict(out.dtypes) == {"id": "int", "label": "double", "r1": "double", "r2": "double", "r3": "double"}
    assert out.count() == n
    jobs.naive_bayes(spark, spec)
    assert spark.read.parquet(f"{tmp_dir}/result").count() == 2 * n


def test_job_matches_query(spark, tmp_dir):
    _tables(spark, tmp_dir)
    res = jobs.naive_bayes(spark, _nb_spec(tmp_dir), write=False)
    ref = catalog.QUERIES["nb_predict"](spark, SF)
    assert sorted(tuple(r) for r in res.collect()) == sorted(tuple(r) for r in ref.collect())


def test_feature_spelling_and_string_numbers(spark, tmp_dir):
    _tables(spark, tmp_dir)
    a = _nb_spec(tmp_dir, smoothing=1)
    b = _nb_spec(tmp_dir, smoothing="1.0")
    b["operational_param"]["train_feature_col"] = b["operational_param"].pop("train_feture_col")
    ra = sorted(tuple(r) for r in jobs.naive_bayes(spark, a, write=False).collect())
    rb = sorted(tuple(r) for r in jobs.naive_bayes(spark, b, write=False).collect())
    assert ra == rb


def test_mismatched_feature_counts_raise_before_spark(spark, tmp_dir):
    spec = _nb_spec(tmp_dir, test_feture_col="t1 t2")   # tables do not even exist
    with pytest.raises(ValueError, match="3 train feature columns but 2 test"):
        jobs.naive_bayes(spark, spec)


def test_kmeans_job_overwrites(spark, tmp_dir):
    catalog.customer_points(spark, SF).write.parquet(f"{tmp_dir}/pts")
    spec = {"datasource": {"train_table": {"path": f"{tmp_dir}/pts"}},
            "output": {"result_table": {"path": f"{tmp_dir}/km"}},
            "operational_param": {"train_feture_col": "f1 f2", "result_label_col": "cluster",
                                  "result_feture_col": "a b", "clusterNum": "3", "iterateNum": 20, "seed": 1}}
    jobs.kmeans(spark, spec)
    jobs.kmeans(spark, spec)
    out = spark.read.parquet(f"{tmp_dir}/km")
    assert out.count() == 150 and out.columns == ["id", "cluster", "a", "b"]
    assert out.select("cluster").distinct().count() == 3


def test_regression_tree_rules_als_jobs(spark, tmp_dir):
    po = catalog.planted_orders(spark, SF)
    po.write.parquet(f"{tmp_dir}/ptrain")
    po.select("id", "f1", "f2").write.parquet(f"{tmp_dir}/ptest")
    base = {"datasource": {"train_table": {"path": f"{tmp_dir}/ptrain"}, "test_table": {"path": f"{tmp_dir}/ptest"}},
            "operational_param": {"train_label_col": "y", "train_feture_col": "f1 f2", "test_feture_col": "f1 f2",
                                  "result_label_col": "label", "result_feture_col": "f1 f2"}}
    tree_spec = {**base, "operational_param": {**base["operational_param"], "numClasses": 3, "maxDepth": 3,
                                               "maxBins": 32}}
    t, rules = jobs.decision_tree(spark, tree_spec, write=False)
    assert "If (feature 0 <= 3.5)" in rules and "Predict: 2.0" in rules
    joined = t.join(po.select(F.col("id").cast("int").alias("id"), "y"), "id")
    assert joined.where("label != y").count() == 0
    lr_spec = {**base, "operational_param": {**base["operational_param"], "stepSize": 0.5, "iterateNum": 100,
                                             "regularizer": "l2"}}
    result, mse = jobs.linear_regression(spark, lr_spec, write=False)
    assert result.count() == po.count() and mse.first()["n"] == po.count()
    lr_spec["operational_param"]["solver"] = "iterative"
    again = jobs.linear_regression(spark, lr_spec, write=False).mse.first()
    assert again["mse"] == pytest.approx(mse.first()["mse"], rel=1e-9)

    catalog.order_baskets(spark, SF, "p_type").write.parquet(f"{tmp_dir}/baskets")
    rules = jobs.association_rules(spark, {
        "datasource": {"train_table": {"path": f"{tmp_dir}/baskets"}},
        "operational_param": {"train_association_col": "basket", "result_rule_col": "rule",
                              "result_conf_col": "conf", "min_support": "0.05", "min_confidence": 0.3}},
        write=False)
    assert rules.columns == ["rule", "conf"] and rules.count() > 0

    r = catalog.cust_supp_ratings(spark, SF)
    r.write.parquet(f"{tmp_dir}/ratings")
    pairs = spark.createDataFrame([(-5, -5)], "u int, i int").union(r.select("user", "item").limit(10))
    pairs.write.parquet(f"{tmp_dir}/pairs")
    out, ratings, mse = jobs.collaborative_filtering(spark, {
        "datasource": {"train_table": {"path": f"{tmp_dir}/ratings"}, "test_table": {"path": f"{tmp_dir}/pairs"}},
        "operational_param": {"train_user_col": "user", "train_item_col": "item", "train_rate_col": "rating",
                              "test_user_col": "u", "test_item_col": "i", "result_user_col": "ru",
                              "result_item_col": "ri", "result_rate_col": "rr", "rank": 4, "numIterations": 5,
                              "seed": 7}}, write=False)
    assert out.columns == ["ru", "ri", "rr"] and out.count() == 10   # unknown pair dropped
    rows = ratings.collect()
    assert len(rows) == r.count() == mse.first()["n"]
    want = sum((x["rating"] - x["prediction"]) ** 2 for x in rows) / len(rows)
    assert abs(mse.first()["mse"] - want) < 1e-9


def test_regression_job_reports_the_mse_of_the_query(spark, tmp_dir):
    catalog.orders_regression(spark, SF).write.parquet(f"{tmp_dir}/o")
    table = {"path": f"{tmp_dir}/o"}
    got = jobs.linear_regression(spark, {
        "datasource": {"train_table": table, "test_table": table},
        "operational_param": {"train_label_col": "y", "train_feture_col": "x1 x2", "test_feture_col": "x1 x2",
                              "result_label_col": "label", "result_feture_col": "x1 x2", "stepSize": 0.5,
                              "iterateNum": 100}}, write=False).mse.first()
    want = catalog.QUERIES["linreg_mse"](spark, SF).first()
    assert got["n"] == want["n"] and abs(got["mse"] - want["mse"]) < 1e-6


def test_bigint_ids_and_clashing_feature_names(spark, tmp_dir):
    rows = [(2 ** 40 + i, float(i % 3), float(i % 3 * 10), float(i % 2)) for i in range(60)]
    spark.createDataFrame(rows, "id long, prediction double, cluster double, label double").write.parquet(f"{tmp_dir}/t")
    table = {"path": f"{tmp_dir}/t"}
    names = {"train_label_col": "label", "train_feture_col": "prediction cluster",
             "test_feture_col": "prediction cluster", "result_label_col": "y", "result_feture_col": "a b",
             "id_type": "bigint"}
    source = {"datasource": {"train_table": table, "test_table": table}}
    want = sorted((r[0], r[1], r[2]) for r in rows)
    nb = jobs.naive_bayes(spark, {**source, "operational_param": names}, write=False)
    tr = jobs.decision_tree(spark, {**source, "operational_param": {**names, "numClasses": 2, "maxDepth": 2, "maxBins": 8}},
                            write=False).result
    km = jobs.kmeans(spark, {**source, "operational_param": {**names, "clusterNum": 3, "iterateNum": 10, "seed": 1}},
                     write=False)
    for out in (nb, tr, km):
        assert sorted((r["id"], r["a"], r["b"]) for r in out.collect()) == want
    assert len({(r["a"], r["y"]) for r in km.collect()}) == 3
    with pytest.raises(ValueError, match="id_type"):
        jobs.naive_bayes(spark, {**source, "operational_param": {**names, "id_type": "text"}}, write=False)


def test_id_as_a_feature(spark, tmp_dir):
    spark.createDataFrame([(i, float(i // 30 * 100)) for i in range(60)], "id int, x double").write.parquet(f"{tmp_dir}/t")
    out = jobs.kmeans(spark, {"datasource": {"train_table": {"path": f"{tmp_dir}/t"}}, "operational_param": {
        "train_feture_col": "id x", "result_label_col": "c", "result_feture_col": "f_id f_x", "clusterNum": 2,
        "iterateNum": 10, "seed": 1}}, write=False)
    assert all(r["id"] == r["f_id"] for r in out.collect())


def test_scored_jdbc_tables_are_split_by_id(spark, monkeypatch):
    from minekit.sources import tables
    seen = []
    monkeypatch.setattr(tables, "with_jdbc_bounds", lambda spark, src: seen.append(src) or (_ for _ in ()).throw(KeyError))
    for src in ({"url": "jdbc:x", "tablename": "t"}, {"url": "jdbc:x", "tablename": "t", "partition_column": "k"},
                {"url": "jdbc:x", "tablename": "t", "partition_column": ""}):
        with pytest.raises(KeyError):
            tables.read_table(spark, src, partition_column="id")
    assert [s["partition_column"] for s in seen] == ["id", "k", ""]


def test_als_rejects_fractional_ids(spark):
    from minekit.operators import als
    df = spark.createDataFrame([(1.5, 1.0, 3.0)], "u double, i double, r double")
    with pytest.raises(Exception):
        als.ratings_frame(df, "u", "i", "r").collect()


def test_text_jobs(spark, tmp_dir):
    lines = spark.createDataFrame([("1 1 1",), ("1.2 1",), ("9 9 9",), ("9.1 9 9",)], "value string")
    lines.write.text(f"{tmp_dir}/vec")
    out = jobs.kmeans_text(spark, f"{tmp_dir}/vec", k=2, iterations=10, seed=1).collect()
    texts = sorted(r[0] for r in out)
    assert texts[0].startswith("[1.0,1.0,1.0]==>") and "[1.2,1.0,0.0]==>" in texts[1]

    ev = catalog.event_table(spark, SF)
    from minekit.operators import bayes
    fit = bayes.fit_naive_bayes(ev, "y", catalog.EVENT_FEATURES)
    fit.save(f"{tmp_dir}/model")
    spark.createDataFrame([("3 69 6.55",)], "value string").write.text(f"{tmp_dir}/in")
    res = jobs.score_text_with_saved_model(spark, f"{tmp_dir}/model", f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert res.first()[0].startswith("(3 69 6.55,")
    with pytest.raises(Exception):   # the text sink refuses an existing folder
        jobs.score_text_with_saved_model(spark, f"{tmp_dir}/model", f"{tmp_dir}/in", f"{tmp_dir}/out")


def test_spec_masks_secrets_and_builds_jdbc_options():
    spec = JobSpec.parse({"datasource": {"train_table": {"database_address": "db", "port": 1521, "database": "orcl",
                                                         "tablename": "t", "account": "u", "password": "p"}},
                          "operational_param": {}})
    assert "p'" not in repr(spec) and "***" in repr(spec)
    opts = jdbc_options({**spec.train_table, "partition_column": "id", "lower_bound": 0, "upper_bound": 100,
                         "num_partitions": 8})
    assert opts["url"] == "jdbc:oracle:thin:@db:1521:orcl"
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id" and opts["user"] == "u"


def test_preview_is_ordered_top_n(spark):
    rows = jobs.preview(spark, {"path": f"{SF}/customer.parquet"}, "c_custkey").collect()
    keys = [r["c_custkey"] for r in rows]
    assert len(keys) == 20 and keys == sorted(keys)


def test_spec_column_lists_split_like_java():
    s = JobSpec.parse({"operational_param": {"a": "x y ", "b": "x  y", "c": "7", "d": 0.5}})
    assert s.columns("a") == ["x", "y"]
    with pytest.raises(ValueError):
        s.columns("b")
    assert s.integer("c") == 7 and s.number("d") == 0.5


def test_fixed_layout_job_and_canonical_kmeans(spark, tmp_dir):
    ev = catalog.event_table(spark, SF)
    ev.select("id", F.col("y").cast("int"), F.col("hour").cast("int"),
                                       F.col("k").cast("int"), F.floor("value").cast("int").alias("v")
                                       ).write.parquet(f"{tmp_dir}/ptrain")
    ev.select("id", "event_type", "hour", "k", "value").write.parquet(f"{tmp_dir}/ptest")
    out = jobs.naive_bayes_fixed_layout(spark, {
        "datasource": {"train_table": {"path": f"{tmp_dir}/ptrain"}, "test_table": {"path": f"{tmp_dir}/ptest"}}},
        write=False)
    ref = catalog.QUERIES["nb_positional"](spark, SF)
    assert out.columns == ["label", "feture1", "feture2", "feture3"]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.collect()))

    catalog.customer_points(spark, SF).write.parquet(f"{tmp_dir}/pts")
    km = jobs.kmeans(spark, {
        "datasource": {"train_table": {"path": f"{tmp_dir}/pts"}},
        "operational_param": {"train_feture_col": "f1 f2", "result_label_col": "c", "result_feture_col": "f1 f2",
                              "clusterNum": 3, "iterateNum": 20, "seed": 5, "canonical_ids": "true"}}, write=False)
    want = catalog.QUERIES["kmeans_fit_predict"](spark, SF)
    assert sorted((r["id"], r["c"]) for r in km.collect()) == sorted((r["id"], r["label"]) for r in want.collect())


def test_jdbc_bounds_given_or_defaulted(spark):
    from minekit.sources.tables import bounds_query, with_jdbc_bounds
    src = {"url": "jdbc:x", "tablename": "t", "partition_column": "id", "lower_bound": 1, "upper_bound": 9}
    out = with_jdbc_bounds(spark, src)
    assert out["num_partitions"] == spark.sparkContext.defaultParallelism
    assert jdbc_options(out)["lowerBound"] == "1"
    assert bounds_query("t", "id") == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM t) minekit_bounds"
    plain = {"url": "jdbc:x", "tablename": "t"}
    assert with_jdbc_bounds(spark, plain) == plain


def test_jdbc_sink_caps_connections():
    opts = jdbc_options({"url": "jdbc:x", "tablename": "r", "num_partitions": 16})
    assert opts["numPartitions"] == "16" and "partitionColumn" not in opts


def test_cli_runs_a_job_from_base64(spark, tmp_dir):
    from minekit import cli
    n = _tables(spark, tmp_dir)
    assert cli.main(["naive_bayes", encode(_nb_spec(tmp_dir))], spark=spark) == 0
    assert spark.read.parquet(f"{tmp_dir}/result").count() == n
    assert cli.main(["no_such_job", "{}"], spark=spark) == 2


def test_cli_text_jobs_and_catalogue_source(spark, tmp_dir):
    from minekit import cli
    spark.createDataFrame([("1 1 1",), ("1.2 1",), ("9 9 9",)], "value string").write.text(f"{tmp_dir}/vec")
    assert cli.main(["kmeans_text", f"{tmp_dir}/vec", f"{tmp_dir}/km", "2", "5"], spark=spark) == 0
    assert spark.read.text(f"{tmp_dir}/km").count() == 3
    assert cli.main(["preview", f"{SF}/customer.parquet", "c_custkey"], spark=spark) == 0

    catalog.customer_points(spark, SF).createOrReplaceTempView("minekit_pts")
    out = jobs.kmeans(spark, {"datasource": {"train_table": {"table": "minekit_pts"}},
                              "operational_param": {"train_feture_col": "f1 f2", "result_label_col": "c",
                                                    "result_feture_col": "f1 f2", "clusterNum": 3,
                                                    "iterateNum": 10, "seed": 1}}, write=False)
    assert out.count() == 150


def test_jdbc_urls_for_both_dialects():
    base = {"database_address": "h", "port": 3306, "database": "d", "tablename": "t"}
    mysql = jdbc_options({**base, "dialect": "mysql"})
    assert mysql["url"].startswith("jdbc:mysql://h:3306/d?") and mysql["driver"] == "com.mysql.cj.jdbc.Driver"
    oracle = jdbc_options(base)
    assert oracle["url"] == "jdbc:oracle:thin:@h:3306:d" and oracle["driver"] == "oracle.jdbc.driver.OracleDriver"
    given = jdbc_options({"url": "jdbc:postgresql://h/d", "tablename": "t", "driver": "org.postgresql.Driver"})
    assert given["url"] == "jdbc:postgresql://h/d" and given["driver"] == "org.postgresql.Driver"


def test_reference_shaped_spec_resolves_to_jdbc():
    from minekit.sources.tables import source_format
    table = {"database_address": "db.example", "port": "1521", "database": "orcl", "tablename": "TRAIN",
             "account": "u", "password": "p"}
    spec = JobSpec.parse(encode({"datasource": {"train_table": table, "test_table": dict(table, tablename="TEST")},
                                 "output": {"result_table": dict(table, tablename="RESULT")},
                                 "operational_param": {"train_label_col": "label", "train_feture_col": "a b c",
                                                       "test_feture_col": "a b c", "result_label_col": "label",
                                                       "result_feture_col": "a b c"}}))
    for t in (spec.train_table, spec.test_table, spec.result_table):
        assert source_format(t) == "jdbc"
    opts = jdbc_options(spec.result_table)
    assert opts["url"] == "jdbc:oracle:thin:@db.example:1521:orcl" and opts["dbtable"] == "RESULT"
    assert opts["driver"] == "oracle.jdbc.driver.OracleDriver" and opts["user"] == "u"
