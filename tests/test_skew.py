"""One key holding a third of all rows: results stay whole and exact."""

import itertools
from collections import Counter

from pyspark.sql import functions as F

from minekit.operators import als, fpm
from minekit.session import materialize


def _skewed_lines(spark):
    # 900 order lines; order 0 holds 300 of them (a third), the rest are spread.
    rows = []
    for i in range(900):
        order = 0 if i < 300 else 1 + i % 200
        rows.append((order, f"b{(i * 7) % 6}"))
    return spark.createDataFrame(rows, "order_key long, brand string")


def test_hot_order_baskets_and_itemsets(spark):
    lines = _skewed_lines(spark)
    baskets = (lines.groupBy("order_key")
               .agg(F.concat_ws(" ", F.array_sort(F.collect_set("brand"))).alias("basket")))
    got = {r["order_key"]: r["basket"] for r in baskets.collect()}
    want = {}
    for o, b in lines.collect():
        want.setdefault(o, set()).add(b)
    assert got == {o: " ".join(sorted(s)) for o, s in want.items()}
    model = fpm.fit_fpgrowth(fpm.baskets(materialize(baskets, "skew-baskets"), "basket"), 0.05, 0.5)
    ours = {(r["itemset"], r["freq"]) for r in fpm.freq_itemsets(model).collect()}
    counts = Counter()
    for items in want.values():
        s = sorted(items)
        for n in range(1, len(s) + 1):
            for combo in itertools.combinations(s, n):
                counts[" ".join(combo)] += 1
    min_count = -(-0.05 * len(want) // 1)
    assert ours == {(k, v) for k, v in counts.items() if v >= min_count}


def test_hot_user_ratings_keep_every_row(spark):
    # user 1 holds a third of the rating rows, and rates item 3 twice.
    rows = [(1, i % 40, float(i % 5 + 1)) for i in range(300)]
    rows += [(2 + i % 50, i % 40, float(i % 4 + 1)) for i in range(600)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = als.fit_als(ratings, rank=3, max_iter=3, seed=1)
    rp = als.rates_and_preds(model, ratings)
    assert rp.count() == len(rows)            # one row per rating, no n x n blow-up
    pairs = spark.createDataFrame([(1, 0), (999, 0), (1, 999)], "user int, item int")
    assert {(r[0], r[1]) for r in als.predict_pairs(model, pairs).collect()} == {(1, 0)}
    keys = als.scorable_pairs(ratings, pairs).collect()
    assert [(r["user"], r["item"]) for r in keys] == [(1, 0)]


def test_hot_order_join_is_split_by_aqe(spark, tmp_dir):
    """The ratings build (lineitem join orders, then group) on a lineitem where
    one order holds a third of the lines: AQE splits the hot join partition
    and the result equals a direct computation."""
    from minekit.plans import catalog

    n = 30_000
    lines = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 5000).cast("long").alias("l_orderkey"),
        (F.col("id") % 97).cast("long").alias("l_suppkey"),
        ((F.col("id") % 50) + 1).cast("double").alias("l_quantity"))
    orders = spark.range(5000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 300).alias("o_custkey"))
    lines.write.parquet(f"{tmp_dir}/lineitem.parquet")
    orders.write.parquet(f"{tmp_dir}/orders.parquet")
    # A real cluster has thousands of partitions, so a third of the rows is
    # far above AQE's skew factor; 16 partitions and factor 3 reproduce that.
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        ratings = catalog.cust_supp_ratings(spark, tmp_dir)
        got = {(r["user"], r["item"]): r["rating"] for r in ratings.collect()}
        plan = ratings._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    pl, po = lines.toPandas(), orders.toPandas()
    want = (pl.merge(po, left_on="l_orderkey", right_on="o_orderkey")
            .groupby(["o_custkey", "l_suppkey"])["l_quantity"].mean())
    assert len(got) == len(want)
    assert all(abs(got[(int(u), int(i))] - v) < 1e-9 for (u, i), v in want.items())
