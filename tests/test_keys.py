"""Row numbers, key dictionaries and ALS over keys that are not 32-bit ids."""

import pytest
from pyspark.sql import functions as F

from minekit.operators import als
from minekit.operators.numbering import dense_ids, number_rows


def _ratings(spark):
    rows = [(u, i, (1 + u % 5) * (1 + i % 3) / 3.0) for u in range(40) for i in range(15) if (u * 7 + i) % 3]
    return spark.createDataFrame(rows, "user int, item int, rating double")


def _scores(df):
    return [(r[0], r[1], r[2]) for r in df.orderBy(*df.columns[:2]).collect()]


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("x"), F.lit("k").alias("_mark")).repartition(13)
    got = number_rows(df, ["x"]).orderBy("number").collect()
    assert [r.number for r in got] == list(range(5000))
    assert [r.x for r in got] == sorted(r.x for r in got)
    assert df.columns + ["number"] == number_rows(df, ["x"]).columns


def test_numbers_with_ties_and_no_rows(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("x"))                       # two hot values
    assert sorted(r.number for r in number_rows(df, ["x"]).collect()) == list(range(300))
    assert number_rows(df.limit(0), ["x"]).count() == 0


def test_dictionary(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "`odd ``name` string")
    table = dense_ids(df, "odd `name")
    assert {tuple(r) for r in table.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    with pytest.raises(ValueError, match="3 distinct values"):
        dense_ids(df, "odd `name", limit=2)
    assert dense_ids(df, "odd `name", limit=3).count() == 3


def test_no_window_over_all_rows(spark):
    """The one single-task window is over the partitions' sizes."""
    df = number_rows(spark.range(1000), ["id"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window and "count(1)" in window


def test_key_types_agree(spark):
    base = als.ratings_frame(_ratings(spark), "user", "item", "rating").cache()
    wide = base.select((F.col("user").cast("long") + 2 ** 40).alias("user"), (F.col("item").cast("long") - 2 ** 50).alias("item"),
                       "rating")
    text = base.select(F.format_string("u%05d", "user").alias("user"), F.format_string("i%05d", "item").alias("item"), "rating")
    got = [_scores(als.predict_pairs(als.fit_keyed_als(r, rank=4, max_iter=8, seed=3), r)) for r in (base, wide, text)]
    plain = _scores(als.predict_pairs(als.fit_als(base, rank=4, max_iter=8, seed=3), base))
    for scores, shift in zip(got, (lambda u, i: (u, i), lambda u, i: (u - 2 ** 40, i + 2 ** 50),
                                   lambda u, i: (int(u[1:]), int(i[1:]))), strict=True):
        assert [shift(u, i) for u, i, _ in scores] == [(u, i) for u, i, _ in plain]
        assert [s for _, _, s in scores] == pytest.approx([s for _, _, s in plain], abs=1e-5)


def test_unknown_keys_are_dropped_and_nulls_raise(spark):
    base = _ratings(spark)
    text = als.ratings_frame(base, "user", "item", "rating", "string")
    model = als.fit_keyed_als(text, rank=2, max_iter=2, seed=1)
    pairs = spark.createDataFrame([("0", "1"), ("0", "none"), ("none", "1")], "user string, item string")
    assert [(r[0], r[1]) for r in als.predict_pairs(model, als.pairs_frame(pairs, "user", "item", "string")).collect()] == [("0", "1")]
    one = als.predict_pairs(model, pairs.limit(1), "u", "i", "r").collect()               # a single pair
    both = {tuple(r)[:2]: r["prediction"] for r in als.rates_and_preds(model, text).collect()}
    assert one[0]["r"] == both[("0", "1")]
    bad = spark.createDataFrame([(None, "1", 1.0)], "user string, item string, rating double")
    with pytest.raises(Exception, match="NULL in column user"):
        als.ratings_frame(bad, "user", "item", "rating", "string").collect()
    with pytest.raises(ValueError, match="keys are one of"):
        als.ratings_frame(bad, "user", "item", "rating", "uuid")


def test_one_pair_with_int_ids(spark):
    ratings = als.ratings_frame(_ratings(spark), "user", "item", "rating")
    model = als.fit_als(ratings, rank=2, max_iter=2, seed=1)
    one = als.predict_pairs(model, spark.createDataFrame([(4, 2)], "user int, item int")).collect()
    factors = {n: {r.id: r.features for r in f.collect()} for n, f in (("u", model.userFactors), ("i", model.itemFactors))}
    assert one[0]["rating"] == pytest.approx(sum(a * b for a, b in zip(factors["u"][4], factors["i"][2])), rel=1e-5)


def test_job_with_text_keys(spark, tmp_dir):
    from minekit.plans import jobs
    base = _ratings(spark)
    base.select(F.concat(F.lit("u"), "user").alias("who"), F.concat(F.lit("i"), "item").alias("what"), "rating").write.parquet(
        f"{tmp_dir}/ratings")
    spark.createDataFrame([("u1", "i2"), ("nobody", "i2")], "a string, b string").write.parquet(f"{tmp_dir}/pairs")
    spec = {"datasource": {"train_table": {"path": f"{tmp_dir}/ratings"}, "test_table": {"path": f"{tmp_dir}/pairs"}},
            "operational_param": {"train_user_col": "who", "train_item_col": "what", "train_rate_col": "rating",
                                  "test_user_col": "a", "test_item_col": "b", "result_user_col": "u", "result_item_col": "i",
                                  "result_rate_col": "r", "rank": 2, "numIterations": 3, "seed": 1, "key_type": "string"}}
    out = jobs.collaborative_filtering(spark, spec, write=False)
    assert [(r.u, r.i) for r in out.result.collect()] == [("u1", "i2")]
    assert out.mse.first()["n"] == base.count()
