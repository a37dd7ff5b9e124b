"""Registered queries that run the composite jobs of ``plans.jobs`` from their specs.

Each writes the job's input tables as parquet under the shared checkpoint
folder, hands the job a spec (base64 JSON, as the command line takes it) with a
result table, and returns that table as read back, so source, operator and
sink are checked together.  The rows are those of the operator's own query, and
so is the SQL.  Importing the module registers them in ``catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.operators import als
from minekit.plans import catalog as c
from minekit.plans import jobs
from minekit.plans.spec import encode
from minekit.session import scratch_path
from minekit.sources import text as text_io
from minekit.sources.tables import load, read_table


def _stored(df: DataFrame, name: str) -> dict:
    """``df`` written as a job's table: its entry in a spec."""
    path = scratch_path(df.sparkSession, f"job-{name}")
    df.write.parquet(path)
    return {"path": path}


def _spec(spark: SparkSession, train: dict, test: dict | None = None, **params) -> tuple[str, dict]:
    """A spec with a fresh result table, and the entry of that table."""
    result = {"path": scratch_path(spark, "job-result")}
    source = {"train_table": train} | ({"test_table": test} if test else {})
    return encode({"datasource": source, "output": {"result_table": result}, "operational_param": params}), result


def _supervised(label: str, train: str, test: str | None = None) -> dict:
    return {"train_label_col": label, "train_feture_col": train, "test_feture_col": test or train,
            "result_label_col": "label", "result_feture_col": train}


@c.register("job_naive_bayes", c.ORACLES["nb_predict"])
def job_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: fit on all events, score them under other column names."""
    ev = c.event_table(spark, sf_dir)
    train = _stored(ev.select("y", *c.EVENT_FEATURES), "train")
    test = _stored(ev.select("id", *[F.col(f).alias(f"t_{f}") for f in c.EVENT_FEATURES]), "test")
    names = " ".join(c.EVENT_FEATURES)
    spec, result = _spec(spark, train, test, **_supervised(
        "y", names, " ".join(f"t_{f}" for f in c.EVENT_FEATURES)))
    jobs.naive_bayes(spark, spec)
    return read_table(spark, result)


@c.register("job_naive_bayes_fixed", c.ORACLES["nb_positional"])
def job_naive_bayes_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout is fixed, the spec names no columns."""
    ev = c.event_table(spark, sf_dir)
    train = ev.select("id", *[F.col(f).cast("int") for f in ("y", "hour", "k")], F.floor("value").cast("int").alias("value"))
    test = ev.select("id", "event_type", *c.EVENT_FEATURES)
    spec, result = _spec(spark, _stored(train, "train"), _stored(test, "test"))
    jobs.naive_bayes_fixed_layout(spark, spec)
    return read_table(spark, result)


@c.register("job_decision_tree", c.ORACLES["dtree_predict"])
def job_decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of depth 3 on the planted orders."""
    po = _stored(c.planted_orders(spark, sf_dir), "orders")
    spec, result = _spec(spark, po, po, **_supervised("y", "f1 f2"), numClasses=3, maxDepth="3", maxBins=32)
    jobs.decision_tree(spark, spec)
    return read_table(spark, result)


def _regression(spark: SparkSession, sf_dir: str) -> tuple[jobs.RegressionResult, dict]:
    orders = _stored(c.orders_regression(spark, sf_dir), "orders")
    spec, result = _spec(spark, orders, orders, **_supervised("y", "x1 x2"), stepSize="0.5", iterateNum=100)
    return jobs.linear_regression(spark, spec), result


@c.register("job_linear_regression", c.ORACLES["linreg_predict"])
def job_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: gradient descent on all orders, which it scores."""
    _, result = _regression(spark, sf_dir)
    return read_table(spark, result).withColumn("label", c.r6(F.col("label")))


@c.register("job_regression_mse", c.ORACLES["linreg_mse"])
def job_regression_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error on the training rows that the same job returns."""
    out, _ = _regression(spark, sf_dir)
    return out.mse.select(c.r6(F.col("mse")).alias("mse"), "n")


@c.register("job_kmeans", c.ORACLES["kmeans_fit_predict"])
def job_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three clusters of customers; the second run overwrites the first."""
    spec, result = _spec(spark, _stored(c.customer_points(spark, sf_dir), "points"), train_feture_col="f1 f2",
                         result_label_col="label", result_feture_col="f1 f2", clusterNum="3", iterateNum=20, seed=1,
                         canonical_ids="true")
    for _ in range(2):
        jobs.kmeans(spark, spec)
    return read_table(spark, result).select("id", "label", *[c.r6(F.col(f)).alias(f) for f in ("f1", "f2")])


@c.register("job_association_rules", c.ORACLES["assoc_rules_text"])
def job_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the part types of an order."""
    spec, result = _spec(spark, _stored(c.order_baskets(spark, sf_dir, "p_type"), "baskets"),
                         train_association_col="basket", result_rule_col="rule", result_conf_col="confidence",
                         min_support="0.05", min_confidence=0.3)
    jobs.association_rules(spark, spec)
    return read_table(spark, result).withColumn("confidence", c.r6(F.col("confidence")))


def _planted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_suppkey").distinct()
    return pairs.withColumn("rating", c.planted_rating(F.col("o_custkey"), F.col("l_suppkey")))


@c.register("job_collaborative_filtering", c.SQL_PLANTED_RATINGS)
def job_collaborative_filtering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted ratings; of the test pairs those of an unknown user or item drop out."""
    rated = _planted_pairs(spark, sf_dir)
    known = rated.select("o_custkey", "l_suppkey")
    test = known.unionByName(known.select("o_custkey", (-1 - F.col("l_suppkey")).alias("l_suppkey"))).unionByName(
        known.select((-1 - F.col("o_custkey")).alias("o_custkey"), "l_suppkey"))
    spec, result = _spec(
        spark, _stored(rated, "ratings"), _stored(test, "pairs"), train_user_col="o_custkey",
        train_item_col="l_suppkey", train_rate_col="rating", test_user_col="o_custkey", test_item_col="l_suppkey",
        result_user_col="user_id", result_item_col="item_id", result_rate_col="rate", rank="8", numIterations=10, seed=7)
    jobs.collaborative_filtering(spark, spec)
    actual = c.planted_rating(F.col("user_id"), F.col("item_id"))
    return read_table(spark, result).select("user_id", "item_id", actual.alias("rating"),
                                            c._close(F.col("rate"), actual))


@c.register("als_one_pair", f"SELECT * FROM ({c.SQL_PLANTED_RATINGS}) r ORDER BY user_id, item_id LIMIT 1")
def als_one_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating of a single pair, that of the least user's least item; an unknown pair has none."""
    ratings, model = c._planted_als(spark, sf_dir)
    user, item = ratings.agg(F.min(F.struct(als.USER, als.ITEM)).alias("p")).first()["p"]
    scored = als.predict_pair(spark, model, user, item).unionByName(als.predict_pair(spark, model, -1 - user, item))
    actual = c.planted_rating(F.col(als.USER), F.col(als.ITEM))
    return scored.select(F.col(als.USER).alias("user_id"), F.col(als.ITEM).alias("item_id"), actual.alias("rating"),
                         c._close(F.col(als.RATING), actual))


@c.register("job_score_text", c.ORACLES["text_result_roundtrip"])
def job_score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model scores text lines into a text result."""
    ev, fit = c._nb_fit(spark, sf_dir)
    model, lines, out = (scratch_path(spark, f"job-{n}") for n in ("model", "lines", "scored"))
    fit.save(model)
    text_io.write_lines(ev.select(F.concat_ws(" ", *[F.col(f).cast("string") for f in c.EVENT_FEATURES]).alias("value")),
                        lines)
    jobs.score_text_with_saved_model(spark, model, lines, out)
    return text_io.read_lines(spark, out)


# Customers in three groups by key, as text; a cluster goes by its least vector.

@c.register("job_kmeans_text", """
WITH p AS (SELECT c_custkey % 3 AS g, '[' || CAST(CAST(c_custkey % 3 * 100 + c_nationkey AS DOUBLE) AS VARCHAR) || ','
                  || CAST(CAST(c_custkey % 3 * 50 AS DOUBLE) AS VARCHAR) || ',0.0]' AS vector FROM customer)
SELECT vector, min(vector) OVER (PARTITION BY g) AS cluster FROM p
""")
def job_kmeans_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two values, padded to three; each comes back as ``[vector]==>cluster``."""
    group = F.pmod("c_custkey", F.lit(3))
    lines = scratch_path(spark, "job-lines")
    text_io.write_lines(load(spark, sf_dir, "customer").select(
        F.concat_ws(" ", (group * 100 + F.col("c_nationkey")).cast("string"), (group * 50).cast("string")).alias("value")),
        lines)
    parts = F.split("assignment", "==>")
    found = jobs.kmeans_text(spark, lines, k=3, iterations=20, seed=1).select(
        parts[0].alias("vector"), parts[1].alias("number"))
    names = found.groupBy("number").agg(F.min("vector").alias("cluster"))
    return found.join(names, "number").select("vector", "cluster")


@c.register("job_preview", c.ORACLES["preview"])
def job_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a stored table by its key."""
    return jobs.preview(spark, {"path": f"{sf_dir}/customer.parquet"}, "c_custkey")
