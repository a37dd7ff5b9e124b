"""Registered queries over the test tables, each with its DuckDB oracle.

Every query reads whole tables under ``sf_dir`` (or what Spark derives
from them) and returns a DataFrame; ``ORACLES`` holds the ANSI/DuckDB SQL
that computes the same rows from the same parquet files.  Column names
match between the two; doubles that come out of arithmetic are rounded to
6 places on both sides.

Models train on and score every row of their table, except where the split
is the feature: ``train_test_split``, ``nb_accuracy`` (accuracy on both sides
of the split ``key % 10 < 7``) and ``als_scorable_pairs*`` (pairs whose user or
item was kept out of training).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.operators import als, bayes, cluster, fpm, regression, tree
from minekit.functions import specs, text
from minekit.operators.frames import preview, project_configured, split_flag
from minekit.operators.labels import distinct_sorted
from minekit.session import materialize, scratch_path
from minekit.sources import commit, splits
from minekit.sources import text as text_io
from minekit.sources.tables import load, read_table, write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- events
# label = position of event_type in the sorted list of types;
# features = hour(ts), props.k, value (all >= 0, as naive Bayes needs).

EVENT_FEATURES = ["hour", "k", "value"]

SQL_EVENTS = """
ev AS (
  SELECT event_id AS id,
         CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS y,
         CAST(hour(ts) AS DOUBLE) AS hour,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
         value,
         CASE WHEN event_id % 10 < 7 THEN 'train' ELSE 'test' END AS split
  FROM events)"""

SQL_ALL = """
tr AS (SELECT * FROM ev)"""

SQL_TRAIN = """
tr AS (SELECT * FROM ev WHERE split = 'train')"""

SQL_NB_FIT = """
cls AS (SELECT y, count(*) AS nc, sum(hour) AS s1, sum(k) AS s2, sum(value) AS s3
        FROM tr GROUP BY y),
tot AS (SELECT sum(nc) AS n, count(*) AS c FROM cls),
par AS (SELECT y,
               ln(nc + 1.0) - ln(n + c * 1.0) AS pi,
               ln(s1 + 1.0) - ln(s1 + s2 + s3 + 3.0) AS t1,
               ln(s2 + 1.0) - ln(s1 + s2 + s3 + 3.0) AS t2,
               ln(s3 + 1.0) - ln(s1 + s2 + s3 + 3.0) AS t3
        FROM cls, tot)"""

SQL_NB_PARAMS = f"{SQL_ALL}, {SQL_NB_FIT}"

SQL_NB_SCORED = """
sc AS (SELECT ev.*, par.y AS pred,
              row_number() OVER (PARTITION BY ev.id
                                 ORDER BY par.pi + par.t1 * ev.hour + par.t2 * ev.k + par.t3 * ev.value DESC,
                                          par.y) AS rk
       FROM ev, par),
best AS (SELECT * FROM sc WHERE rk = 1)"""


def wall_clock_hour(df: DataFrame, name: str) -> Column:
    """Hour of a zone-less timestamp, whatever type the reader gave it.

    ``timestamp_ntz`` has no zone to apply.  A reader that maps the column
    to a local timestamp stores the same wall clock as a UTC instant, so
    the hour comes from epoch arithmetic, not from the session time zone.
    """
    if df.schema[name].dataType.simpleString() == "timestamp_ntz":
        return F.hour(F.col(name))
    return F.pmod(F.floor(F.unix_micros(F.col(name)) / F.lit(3_600_000_000)), F.lit(24))


def event_types(spark: SparkSession, sf_dir: str) -> list[str]:
    return distinct_sorted(load(spark, sf_dir, "events"), F.col("event_type"))


def event_table(spark: SparkSession, sf_dir: str, types: list[str] | None = None) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    types = types if types is not None else event_types(spark, sf_dir)
    label = (F.array_position(F.array(*[F.lit(t) for t in types]), F.col("event_type")) - 1)
    return ev.select(
        F.col("event_id").alias("id"),
        label.cast("double").alias("y"),
        wall_clock_hour(ev, "ts").cast("double").alias("hour"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("value"),
        split_flag(F.col("event_id")).alias("split"),
        F.col("event_type"),
    )


def _nb_fit(spark: SparkSession, sf_dir: str):
    ev = event_table(spark, sf_dir)
    return ev, bayes.fit_naive_bayes(ev, "y", EVENT_FEATURES)


@register("nb_predict", f"""
WITH {SQL_EVENTS}, {SQL_NB_PARAMS}, {SQL_NB_SCORED}
SELECT CAST(id AS INTEGER) AS id, pred AS label, hour, k, value FROM best
""")
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes job core: fit on and score every event."""
    ev, fit = _nb_fit(spark, sf_dir)
    return bayes.predict_naive_bayes(fit, ev, EVENT_FEATURES, result_label="label")


@register("nb_model_params", f"""
WITH {SQL_EVENTS}, {SQL_NB_PARAMS}
SELECT y AS label, f.idx AS feature_idx, f.name AS feature, round(pi, 6) AS pi,
       round(CASE f.idx WHEN 0 THEN t1 WHEN 1 THEN t2 ELSE t3 END, 6) AS theta
FROM par, (VALUES (0, 'hour'), (1, 'k'), (2, 'value')) AS f(idx, name)
""")
def nb_model_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fit = _nb_fit(spark, sf_dir)
    p = bayes.naive_bayes_params(spark, fit)
    return p.select("label", "feature_idx", "feature", r6(F.col("pi")).alias("pi"), r6(F.col("theta")).alias("theta"))


@register("nb_accuracy", f"""
WITH {SQL_EVENTS}, {SQL_TRAIN}, {SQL_NB_FIT}, {SQL_NB_SCORED}
SELECT split, round(avg(CASE WHEN pred = y THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n
FROM best GROUP BY split
""")
def nb_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy on the train and the held-out side (dormant metric A2)."""
    ev = event_table(spark, sf_dir)
    fit = bayes.fit_naive_bayes(ev.where(F.col("split") == "train"), "y", EVENT_FEATURES)
    scored = bayes.score(fit, ev, EVENT_FEATURES)
    acc = bayes.accuracy(scored, "prediction", "y", by=["split"])
    return acc.select("split", r6(F.col("accuracy")).alias("accuracy"), "n")


# ------------------------------------------------------------ regression
# lineitem: y = price / 10000, x1 = quantity / 50, x2 = linenumber / 7
# orders:   y = totalprice / 100000, x1 = (custkey % 11) / 11, x2 = (orderkey % 7) / 7

def lineitem_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select((F.col("l_extendedprice") / 10000.0).alias("y"),
                     (F.col("l_quantity") / 50.0).alias("x1"),
                     (F.col("l_linenumber").cast("double") / 7.0).alias("x2"))


def orders_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    (F.col("o_totalprice") / 100000.0).alias("y"),
                    (F.pmod("o_custkey", F.lit(11)).cast("double") / 11.0).alias("x1"),
                    (F.pmod("o_orderkey", F.lit(7)).cast("double") / 7.0).alias("x2"))


SQL_LINEITEM_REG = """
d AS (SELECT l_extendedprice / 10000.0 AS y, l_quantity / 50.0 AS x1,
             CAST(l_linenumber AS DOUBLE) / 7.0 AS x2 FROM lineitem)"""

SQL_ORDERS_REG = """
od AS (SELECT o_orderkey AS id, o_totalprice / 100000.0 AS y,
              CAST(o_custkey % 11 AS DOUBLE) / 11.0 AS x1,
              CAST(o_orderkey % 7 AS DOUBLE) / 7.0 AS x2 FROM orders),
d AS (SELECT y, x1, x2 FROM od)"""


def sgd_sql(step: float, iterations: int, reg: str, reg_param: float = 0.01) -> str:
    """Recursive CTE ``fin(t, w1, w2)`` of the SGD recurrence on CTE ``d``."""
    s = f"({step} / sqrt(it.t + 1))"
    g1 = "(g.a11 * it.w1 + g.a12 * it.w2 - g.b1)"
    g2 = "(g.a12 * it.w1 + g.a22 * it.w2 - g.b2)"
    if reg == "none":
        u1, u2 = f"it.w1 - {s} * {g1}", f"it.w2 - {s} * {g2}"
    elif reg == "l2":
        u1 = f"(1 - {s} * {reg_param}) * it.w1 - {s} * {g1}"
        u2 = f"(1 - {s} * {reg_param}) * it.w2 - {s} * {g2}"
    else:
        z1, z2 = f"(it.w1 - {s} * {g1})", f"(it.w2 - {s} * {g2})"
        u1 = f"sign({z1}) * greatest(0.0, abs({z1}) - {s} * {reg_param})"
        u2 = f"sign({z2}) * greatest(0.0, abs({z2}) - {s} * {reg_param})"
    return f"""
g AS (SELECT sum(x1 * x1) / count(*) AS a11, sum(x1 * x2) / count(*) AS a12,
             sum(x2 * x2) / count(*) AS a22, sum(x1 * y) / count(*) AS b1,
             sum(x2 * y) / count(*) AS b2 FROM d),
it(t, w1, w2, done) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), false
  UNION ALL
  SELECT t + 1, nw1, nw2,
         t + 1 >= 2 AND sqrt((nw1 - w1) * (nw1 - w1) + (nw2 - w2) * (nw2 - w2))
                        < 0.001 * greatest(sqrt(nw1 * nw1 + nw2 * nw2), 1.0)
  FROM (SELECT it.t, it.w1, it.w2, {u1} AS nw1, {u2} AS nw2
        FROM it, g WHERE NOT it.done AND it.t < {iterations}) s),
fin AS (SELECT t, w1, w2 FROM it ORDER BY t DESC LIMIT 1)"""


def _weights_sql(step: float, iterations: int, reg: str) -> str:
    return f"""
WITH RECURSIVE {SQL_LINEITEM_REG}, {sgd_sql(step, iterations, reg)}
SELECT f.idx AS feature_idx, f.name AS feature,
       round(CASE f.idx WHEN 0 THEN w1 ELSE w2 END, 6) AS weight, CAST(t AS INTEGER) AS iterations
FROM fin, (VALUES (0, 'x1'), (1, 'x2')) AS f(idx, name)"""


def _weights_query(step: float, iterations: int, reg: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fit = regression.fit_sgd(lineitem_regression(spark, sf_dir), "y", ["x1", "x2"],
                                 iterations=iterations, step=step, reg=reg)
        w = regression.weights_frame(spark, fit)
        return w.select("feature_idx", "feature", r6(F.col("weight")).alias("weight"), "iterations")
    return run


register("linreg_sgd_weights", _weights_sql(0.5, 100, "none"))(_weights_query(0.5, 100, "none"))
register("ridge_sgd_weights", _weights_sql(1.0, 100, "l2"))(_weights_query(1.0, 100, "l2"))
register("lasso_sgd_weights", _weights_sql(1.0, 100, "l1"))(_weights_query(1.0, 100, "l1"))


def _orders_sgd(spark: SparkSession, sf_dir: str):
    od = orders_regression(spark, sf_dir)
    fit = regression.fit_sgd(od, "y", ["x1", "x2"], iterations=100, step=0.5)
    return od, fit


@register("linreg_predict", f"""
WITH RECURSIVE {SQL_ORDERS_REG}, {sgd_sql(0.5, 100, "none")}
SELECT CAST(od.id AS INTEGER) AS id, round(fin.w1 * od.x1 + fin.w2 * od.x2, 6) AS label, od.x1, od.x2
FROM od, fin
""")
def linreg_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    od, fit = _orders_sgd(spark, sf_dir)
    out = regression.predict_sgd(fit, od, ["x1", "x2"], result_label="label")
    return out.withColumn("label", r6(F.col("label")))


@register("linreg_mse", f"""
WITH RECURSIVE {SQL_ORDERS_REG}, {sgd_sql(0.5, 100, "none")}
SELECT round(avg((fin.w1 * d.x1 + fin.w2 * d.x2 - d.y) * (fin.w1 * d.x1 + fin.w2 * d.x2 - d.y)), 6) AS mse,
       count(*) AS n
FROM d, fin
""")
def linreg_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean squared error on the training rows (the reference's MSE1)."""
    od, fit = _orders_sgd(spark, sf_dir)
    m = regression.mse(fit, od, "y", ["x1", "x2"])
    return m.select(r6(F.col("mse")).alias("mse"), "n")


# --------------------------------------------------------------- baskets
# One basket per order: its distinct part brands (or part types), space separated.

def order_baskets(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = load(spark, sf_dir, "part").select("p_partkey", attr)
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return (joined.groupBy("l_orderkey")
            .agg(F.concat_ws(" ", F.array_sort(F.collect_set(attr))).alias("basket")))


def sql_baskets(attr: str) -> str:
    return f"""
b AS (SELECT l.l_orderkey AS bid, list_sort(list_distinct(list(p.{attr}))) AS items
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)"""


def sql_itemsets(min_support: float) -> str:
    """Recursive CTE ``fi(items, freq)``: sorted item lists grown one item at a time."""
    return f"""
m AS (SELECT ceil({min_support} * count(*)) AS minc FROM b),
f1 AS (SELECT it AS item, count(*) AS c FROM (SELECT unnest(items) AS it FROM b) s
       GROUP BY it HAVING count(*) >= (SELECT minc FROM m)),
grow(items, last, freq) AS (
  SELECT [item], item, c FROM f1
  UNION ALL
  SELECT nx.items, nx.last, nx.freq FROM (
    SELECT list_append(g.items, f1.item) AS items, f1.item AS last,
           (SELECT count(*) FROM b WHERE list_has_all(b.items, list_append(g.items, f1.item))) AS freq
    FROM grow g JOIN f1 ON f1.item > g.last) nx
  WHERE nx.freq >= (SELECT minc FROM m)),
fi AS (SELECT items, freq FROM grow)"""


SQL_RULES = """
ex AS (SELECT items, freq, unnest(items) AS cons FROM fi WHERE len(items) >= 2),
rules AS (SELECT list_filter(ex.items, lambda x: x <> ex.cons) AS ante, ex.cons AS cons,
                 ex.freq * 1.0 / a.freq AS confidence
          FROM ex JOIN fi a ON a.items = list_filter(ex.items, lambda x: x <> ex.cons))"""


def _fp_model(spark, sf_dir, attr, support, confidence):
    # FP-growth reads its input several times (count, item counts, trees):
    # write the baskets once instead of re-running the join + group-by.
    bk = fpm.baskets(materialize(order_baskets(spark, sf_dir, attr), "baskets"), "basket")
    return fpm.fit_fpgrowth(bk, support, confidence)


@register("basket_tokenize", f"""
WITH {sql_baskets('p_brand')}
SELECT CAST(bid AS BIGINT) AS order_key, array_to_string(items, ' ') AS basket,
       CAST(len(items) AS INTEGER) AS n_items,
       items[1] AS first_item, items[len(items)] AS last_item
FROM b
""")
def basket_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets built as text, split back into item arrays."""
    bk = order_baskets(spark, sf_dir, "p_brand")
    items = fpm.basket_items(F.col("basket"))
    return bk.select(F.col("l_orderkey").alias("order_key"), "basket", F.size(items).alias("n_items"),
                     F.element_at(items, 1).alias("first_item"), F.element_at(items, -1).alias("last_item"))


@register("freq_itemsets", f"""
WITH RECURSIVE {sql_baskets('p_brand')}, {sql_itemsets(0.01)}
SELECT array_to_string(items, ' ') AS itemset, CAST(len(items) AS INTEGER) AS size, freq FROM fi
""")
def freq_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fpm.freq_itemsets(_fp_model(spark, sf_dir, "p_brand", 0.01, 0.1))


@register("assoc_rules", f"""
WITH RECURSIVE {sql_baskets('p_brand')}, {sql_itemsets(0.01)}, {SQL_RULES}
SELECT array_to_string(ante, ' ') AS antecedent, cons AS consequent, round(confidence, 6) AS confidence
FROM rules WHERE confidence >= 0.1
""")
def assoc_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fpm.association_rules(_fp_model(spark, sf_dir, "p_brand", 0.01, 0.1))
    return r.withColumn("confidence", r6(F.col("confidence")))


@register("assoc_rules_text", f"""
WITH RECURSIVE {sql_baskets('p_type')}, {sql_itemsets(0.05)}, {SQL_RULES}
SELECT '[' || array_to_string(ante, ', ') || '] => [' || cons || ']' AS rule,
       round(confidence, 6) AS confidence
FROM rules WHERE confidence >= 0.3
""")
def assoc_rules_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types per order, support 0.05: itemsets up to size 4, text rules."""
    r = fpm.rule_text(_fp_model(spark, sf_dir, "p_type", 0.05, 0.3), "rule", "confidence")
    return r.withColumn("confidence", r6(F.col("confidence")))


@register("freq_itemsets_types", f"""
WITH RECURSIVE {sql_baskets('p_type')}, {sql_itemsets(0.05)}
SELECT array_to_string(items, ' ') AS itemset, CAST(len(items) AS INTEGER) AS size, freq FROM fi
""")
def freq_itemsets_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fpm.freq_itemsets(_fp_model(spark, sf_dir, "p_type", 0.05, 0.3))


# --------------------------------------------------------------- k-means
# customer: f1 = (custkey % 3) * 100 + nationkey * 0.1, f2 = (custkey % 3) * -50
# -> three well separated groups; cluster ids made canonical (smallest key).

def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    grp = F.pmod("c_custkey", F.lit(3)).cast("double")
    return c.select(F.col("c_custkey").alias("id"),
                    (grp * 100.0 + F.col("c_nationkey").cast("double") * 0.1).alias("f1"),
                    (grp * -50.0).alias("f2"))


@register("kmeans_fit_predict", """
WITH c AS (SELECT CAST(c_custkey AS INTEGER) AS id,
                  CAST(c_custkey % 3 AS DOUBLE) * 100.0 + CAST(c_nationkey AS DOUBLE) * 0.1 AS f1,
                  CAST(c_custkey % 3 AS DOUBLE) * -50.0 AS f2
           FROM customer)
SELECT id, CAST(min(id) OVER (PARTITION BY f2) AS DOUBLE) AS label, round(f1, 6) AS f1, round(f2, 6) AS f2
FROM c
""")
def kmeans_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = customer_points(spark, sf_dir)
    model = cluster.fit_kmeans(pts, ["f1", "f2"], k=3, max_iter=20, seed=1)
    out = cluster.predict_kmeans(model, pts, ["f1", "f2"], result_label="label", canonical=True)
    return out.select("id", "label", r6(F.col("f1")).alias("f1"), r6(F.col("f2")).alias("f2"))


# Given centres: the mean (value, k) of each event type, in type order;
# every event goes to the nearest one (ties to the lowest index).

def event_centres(ev: DataFrame) -> list[list[float]]:
    rows = (ev.groupBy("event_type").agg(F.avg("value").alias("cv"), F.avg("k").alias("ck"))
            .orderBy("event_type").collect())          # one row per event type
    return [[r["cv"], r["ck"]] for r in rows]


SQL_CENTRES = """
ev AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
ce AS (SELECT dense_rank() OVER (ORDER BY event_type) - 1 AS idx, avg(value) AS cv, avg(k) AS ck
       FROM ev GROUP BY event_type),
asg AS (SELECT ev.event_id, ev.value, ev.k, ce.idx,
               row_number() OVER (PARTITION BY ev.event_id
                                  ORDER BY (ev.value - ce.cv) * (ev.value - ce.cv) + (ev.k - ce.ck) * (ev.k - ce.ck),
                                           ce.idx) AS rk
        FROM ev, ce)"""


def _event_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    centres = event_centres(ev)
    return ev.select("event_id", "value", "k",
                     cluster.nearest_centre([F.col("value"), F.col("k")], centres).alias("cluster"))


@register("kmeans_assign", f"""
WITH {SQL_CENTRES}
SELECT CAST(event_id AS INTEGER) AS id, CAST(idx AS INTEGER) AS cluster, value, k FROM asg WHERE rk = 1
""")
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _event_assignment(spark, sf_dir)
    return a.select(F.col("event_id").cast("int").alias("id"), "cluster", "value", "k")


@register("kmeans_assign_text", f"""
WITH {SQL_CENTRES}
SELECT CAST(event_id AS INTEGER) AS id,
       '[' || CAST(value AS VARCHAR) || ',' || CAST(k AS VARCHAR) || ']==>' || CAST(idx AS VARCHAR) AS assignment
FROM asg WHERE rk = 1
""")
def kmeans_assign_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _event_assignment(spark, sf_dir)
    return a.select(F.col("event_id").cast("int").alias("id"),
                    cluster.assignment_text([F.col("value"), F.col("k")], F.col("cluster")).alias("assignment"))


# ---------------------------------------------------------- decision tree
# orders with a planted rule: f1 = orderkey % 7, f2 = custkey % 11,
# label 0 if f1 < 4, else 1 if f2 >= 6, else 2.

def planted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    f1 = F.pmod("o_orderkey", F.lit(7)).cast("double")
    f2 = F.pmod("o_custkey", F.lit(11)).cast("double")
    y = F.when(f1 < 4, 0.0).when(f2 >= 6, 1.0).otherwise(2.0)
    return o.select(F.col("o_orderkey").alias("id"), f1.alias("f1"), f2.alias("f2"), y.alias("y"))


SQL_PLANTED = """
o AS (SELECT o_orderkey AS id, CAST(o_orderkey % 7 AS DOUBLE) AS f1, CAST(o_custkey % 11 AS DOUBLE) AS f2
      FROM orders),
p AS (SELECT id, f1, f2, CASE WHEN f1 < 4 THEN 0.0 WHEN f2 >= 6 THEN 1.0 ELSE 2.0 END AS y FROM o)"""


@register("dtree_predict", f"""
WITH {SQL_PLANTED}
SELECT CAST(id AS INTEGER) AS id, CAST(y AS DOUBLE) AS label, f1, f2 FROM p
""")
def dtree_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree of depth 3 trained on all orders must recover the rule everywhere."""
    po = planted_orders(spark, sf_dir)
    fit = tree.fit_decision_tree(po, "y", ["f1", "f2"], max_depth=3, max_bins=32, num_classes=3)
    return tree.predict_decision_tree(fit, po, ["f1", "f2"], result_label="label")


@register("dtree_best_split", f"""
WITH {SQL_PLANTED},
lng AS (SELECT 0 AS f, f1 AS v, y FROM p UNION ALL SELECT 1 AS f, f2 AS v, y FROM p),
vals AS (SELECT DISTINCT f, v FROM lng),
thr AS (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS t FROM vals),
cand AS (SELECT f, t FROM thr WHERE t IS NOT NULL),
cnt AS (SELECT c.f, c.t, l.y,
               sum(CASE WHEN l.v <= c.t THEN 1 ELSE 0 END) AS nl_y,
               sum(CASE WHEN l.v > c.t THEN 1 ELSE 0 END) AS nr_y
        FROM cand c JOIN lng l ON l.f = c.f GROUP BY c.f, c.t, l.y),
agg AS (SELECT f, t, CAST(sum(nl_y) AS DOUBLE) AS nl, CAST(sum(nr_y) AS DOUBLE) AS nr,
               CAST(sum(nl_y * nl_y) AS DOUBLE) AS sl, CAST(sum(nr_y * nr_y) AS DOUBLE) AS sr,
               CAST(sum(nl_y + nr_y) AS DOUBLE) AS n,
               CAST(sum((nl_y + nr_y) * (nl_y + nr_y)) AS DOUBLE) AS st
        FROM cnt GROUP BY f, t),
gn AS (SELECT f, t, (1 - st / (n * n)) - nl / n * (1 - sl / (nl * nl)) - nr / n * (1 - sr / (nr * nr)) AS gain
       FROM agg WHERE nl > 0 AND nr > 0)
SELECT f AS feature_idx, CASE f WHEN 0 THEN 'f1' ELSE 'f2' END AS feature, t AS threshold,
       round(gain, 6) AS gain
FROM gn WHERE gain > 0 ORDER BY round(gain, 12) DESC, f, t LIMIT 1
""")
def dtree_best_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best gini root split over all orders (every midpoint is a candidate here)."""
    po = planted_orders(spark, sf_dir)
    best = tree.best_split(po, "y", ["f1", "f2"], max_bins=32)
    return best.select("feature_idx", "feature", "threshold", r6(F.col("gain")).alias("gain"))


@register("dtree_rules", f"""
WITH {SQL_PLANTED},
n(node, parent, feature, threshold, label, lo1, hi1, lo2, hi2) AS (VALUES
  (1, NULL, 'f1', 3.5, NULL, -1, 99, -1, 99), (2, 1, NULL, NULL, 0.0, -1, 4, -1, 99),
  (3, 1, 'f2', 5.5, NULL, 4, 99, -1, 99), (6, 3, NULL, NULL, 2.0, 4, 99, -1, 6), (7, 3, NULL, NULL, 1.0, 4, 99, 6, 99))
SELECT CAST(node AS BIGINT) AS node, CAST(parent AS BIGINT) AS parent, feature, CAST(threshold AS DOUBLE) AS threshold,
       CAST(label AS DOUBLE) AS label, count(p.id) AS n_rows
FROM n JOIN p ON f1 >= lo1 AND f1 < hi1 AND f2 >= lo2 AND f2 < hi2
GROUP BY node, parent, feature, threshold, label
""")
def dtree_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted tree's nodes, with the orders that pass each on their walk from the root."""
    po = planted_orders(spark, sf_dir)
    fit = tree.fit_decision_tree(po, "y", ["f1", "f2"], max_depth=3, max_bins=32, num_classes=3)
    nodes = tree.node_table(fit, spark)
    leaves = tree.walk(nodes, po, "leaf", "found").groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    path = F.expr("transform(sequence(0, length(bin(leaf)) - 1), i -> shiftright(leaf, i))")      # the leaf and all above it
    passed = leaves.select(F.explode(path).alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n_rows"))
    leaf_label = F.when(F.col("feature").isNull(), F.col("label")).alias("label")
    return nodes.join(passed, "node").select("node", "parent", "feature", "threshold", leaf_label, "n_rows")


@register("dtree_walk", f"""
WITH {SQL_PLANTED}
SELECT id, f1, f2, CAST(CASE WHEN f1 < 4 THEN 2 WHEN f2 < 6 THEN 6 ELSE 7 END AS BIGINT) AS leaf, CAST(y AS DOUBLE) AS label
FROM p
""")
def dtree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order led through the node table."""
    po = planted_orders(spark, sf_dir)
    fit = tree.fit_decision_tree(po, "y", ["f1", "f2"], max_depth=3, max_bins=32, num_classes=3)
    return tree.walk(tree.node_table(fit, spark), po.select("id", "f1", "f2"), "leaf", "label")


# -------------------------------------------------------------------- ALS
# als_scorable_pairs*: ratings are the mean quantity per (customer, supplier).
# Training keeps the pairs with (user * 31 + item) % 10 < 7 and plants
# cold-start keys by leaving out users % 50 == 0 and items % 25 == 0; every
# pair is then scored.
#
# als_predict_pairs, als_rates_and_preds: the rating of a pair is planted with
# rank 2, (1 + user % 5) * (1 + item % 3) / 3 + (item % 4) / 4, so a model fitted
# to all pairs has to come within 0.5 of it.

def cust_supp_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    r = (li.join(o, li.l_orderkey == o.o_orderkey)
         .groupBy("o_custkey", "l_suppkey").agg(F.avg("l_quantity").alias("rating")))
    return als.ratings_frame(r, "o_custkey", "l_suppkey", "rating")


def als_train_flag() -> Column:
    u, i = F.col(als.USER), F.col(als.ITEM)
    return ((F.pmod(u * 31 + i, F.lit(10)) < 7) & (F.pmod(u, F.lit(50)) != 0) & (F.pmod(i, F.lit(25)) != 0))


SQL_RATINGS = """
r AS (SELECT o.o_custkey AS u, l.l_suppkey AS i, avg(l.l_quantity) AS rating
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey, l.l_suppkey),
tr AS (SELECT * FROM r WHERE (u * 31 + i) % 10 < 7 AND u % 50 <> 0 AND i % 25 <> 0)"""


def _als(spark: SparkSession, sf_dir: str):
    # Fit and scoring both read the ratings: aggregate them once.
    ratings = materialize(cust_supp_ratings(spark, sf_dir), "ratings")
    train = ratings.where(als_train_flag())
    model = als.fit_als(train, rank=8, max_iter=10, reg_param=0.01, seed=7)
    return ratings, train, model


@register("als_scorable_pairs", f"""
WITH {SQL_RATINGS}
SELECT CAST(u AS INTEGER) AS user_id, CAST(i AS INTEGER) AS item_id FROM r
WHERE u IN (SELECT u FROM tr) AND i IN (SELECT i FROM tr)
""")
def als_scorable_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the pairs the fitted model scores (cold-start pairs dropped)."""
    ratings, _, model = _als(spark, sf_dir)
    pred = als.predict_pairs(model, ratings, "user_id", "item_id", "rate")
    return pred.select("user_id", "item_id")


@register("als_scorable_pairs_semijoin", f"""
WITH {SQL_RATINGS}
SELECT CAST(u AS INTEGER) AS user_id, CAST(i AS INTEGER) AS item_id FROM r
WHERE u IN (SELECT u FROM tr) AND i IN (SELECT i FROM tr)
""")
def als_scorable_pairs_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same key set without fitting: two left-semi joins."""
    # The pair table is read three times (pairs, users, items): write it once.
    ratings = materialize(cust_supp_ratings(spark, sf_dir), "ratings")
    keys = als.scorable_pairs(ratings.where(als_train_flag()), ratings)
    return keys.select(F.col(als.USER).alias("user_id"), F.col(als.ITEM).alias("item_id"))


def planted_rating(user: Column, item: Column) -> Column:
    return ((1 + F.pmod(user, F.lit(5))) * (1 + F.pmod(item, F.lit(3))) / 3.0
            + F.pmod(item, F.lit(4)) / 4.0).cast("double")


SQL_PLANTED_RATINGS = """
SELECT DISTINCT CAST(o.o_custkey AS INTEGER) AS user_id, CAST(l.l_suppkey AS INTEGER) AS item_id,
       CAST((1 + o.o_custkey % 5) * (1 + l.l_suppkey % 3) / 3.0 + (l.l_suppkey % 4) / 4.0 AS DOUBLE) AS rating,
       true AS close
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def _planted_als(spark: SparkSession, sf_dir: str):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_suppkey").distinct()
    rated = pairs.withColumn("rating", planted_rating(F.col("o_custkey"), F.col("l_suppkey")))
    ratings = materialize(als.ratings_frame(rated, "o_custkey", "l_suppkey", "rating"), "ratings")
    return ratings, als.fit_als(ratings, rank=8, max_iter=10, reg_param=0.01, seed=7)


def _close(prediction: Column, rating: Column) -> Column:
    return (F.abs(prediction - rating) <= 0.5).alias("close")


@register("als_predict_pairs", SQL_PLANTED_RATINGS)
def als_predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair scored, next to the rating planted for it."""
    ratings, model = _planted_als(spark, sf_dir)
    scored = als.predict_pairs(model, ratings, "user_id", "item_id", "rate")
    actual = planted_rating(F.col("user_id"), F.col("item_id"))
    return scored.select("user_id", "item_id", actual.alias("rating"), _close(F.col("rate"), actual))


@register("als_rates_and_preds", SQL_PLANTED_RATINGS)
def als_rates_and_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training ratings next to their predictions."""
    ratings, model = _planted_als(spark, sf_dir)
    rp = als.rates_and_preds(model, ratings)
    return rp.select(F.col(als.USER).alias("user_id"), F.col(als.ITEM).alias("item_id"), "rating",
                     _close(F.col("prediction"), F.col("rating")))


# Keys beyond 32 bits: users moved up by 2^33, items as text.

SQL_KEYED_RATINGS = """
SELECT DISTINCT CAST(o.o_custkey + 8589934592 AS BIGINT) AS user_id, 'supplier ' || l.l_suppkey AS item_id,
       CAST((1 + o.o_custkey % 5) * (1 + l.l_suppkey % 3) / 3.0 + (l.l_suppkey % 4) / 4.0 AS DOUBLE) AS rating,
       true AS close
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


@register("als_wide_keys", SQL_KEYED_RATINGS)
def als_wide_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted ratings under keys that do not fit 32 bits, numbered by dictionaries for the fit."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_suppkey").distinct()
    ratings = materialize(pairs.select(
        (F.col("o_custkey") + F.lit(2 ** 33)).alias(als.USER), F.concat(F.lit("supplier "), "l_suppkey").alias(als.ITEM),
        planted_rating(F.col("o_custkey"), F.col("l_suppkey")).alias(als.RATING)), "ratings")
    model = als.fit_keyed_als(ratings, rank=8, max_iter=10, reg_param=0.01, seed=7)
    rp = als.rates_and_preds(model, ratings)
    return rp.select(F.col(als.USER).alias("user_id"), F.col(als.ITEM).alias("item_id"), "rating",
                     _close(F.col("prediction"), F.col("rating")))


# ------------------------------------------------- text, specs, plumbing

def _text_roundtrip(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Write lines to a fresh folder under the shared checkpoint dir, read back."""
    path = scratch_path(spark, name)
    text_io.write_lines(lines, path)
    return text_io.read_lines(spark, path)


def _num(c: str) -> Column:
    return F.col(c).cast("string")


@register("parse_labeled_text", f"""
WITH {SQL_EVENTS}
SELECT y AS label, hour AS f1, k AS f2, value AS f3 FROM ev
""")
def parse_labeled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``label,f1 f2 f3`` lines (from events) through a text file and back."""
    ev = event_table(spark, sf_dir)
    lines = ev.select(F.concat(_num("y"), F.lit(","), F.concat_ws(" ", _num("hour"), _num("k"), _num("value")))
                      .alias("value"))
    parsed = text.parse_labeled_lines(_text_roundtrip(spark, lines, "labeled"), "value", 3)
    return parsed.select(F.col("label"), F.col("f1"), F.col("f2"), F.col("f3"))


@register("parse_vector_text", f"""
WITH {SQL_EVENTS}
SELECT value AS f1, k AS f2, CAST(0.0 AS DOUBLE) AS f3 FROM ev
""")
def parse_vector_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-value lines read by the k-means parser, which pads to three."""
    ev = event_table(spark, sf_dir)
    lines = ev.select(F.concat_ws(" ", _num("value"), _num("k")).alias("value"))
    tokens = text.java_split(F.col("value"), " ")
    vals = text.parse_values(tokens, 3, pad=True, what="vector line")
    return _text_roundtrip(spark, lines, "vectors").select(*[v.alias(f"f{i + 1}") for i, v in enumerate(vals)])


def _saved_nb(spark: SparkSession, sf_dir: str):
    ev, fit = _nb_fit(spark, sf_dir)
    path = scratch_path(spark, "nb-model")
    fit.save(path)
    return ev, bayes.NaiveBayesFit.load(spark, path)


@register("score_saved_model", ORACLES["nb_predict"])
def score_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the fitted model, load it back, score every event."""
    ev, loaded = _saved_nb(spark, sf_dir)
    return bayes.predict_naive_bayes(loaded, ev, EVENT_FEATURES, result_label="label")


@register("text_result_roundtrip", f"""
WITH {SQL_EVENTS}, {SQL_NB_PARAMS}, {SQL_NB_SCORED}
SELECT '(' || CAST(hour AS VARCHAR) || ' ' || CAST(k AS VARCHAR) || ' ' || CAST(value AS VARCHAR)
       || ',' || CAST(pred AS VARCHAR) || ')' AS value
FROM best
""")
def text_result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score ``f1 f2 f3`` text lines with a saved model and write
    ``(line,prediction)`` text (the target must not exist); read it back."""
    ev, loaded = _saved_nb(spark, sf_dir)
    lines = _text_roundtrip(spark, ev.select(F.concat_ws(" ", _num("hour"), _num("k"), _num("value"))
                                             .alias("value")), "score-input")
    vals = text.parse_values(text.java_split(F.col("value"), " "), 3, pad=False, what="vector line")
    parsed = lines.select(F.col("value").alias("line"), *[v.alias(c) for v, c in zip(vals, EVENT_FEATURES)])
    scored = bayes.score(loaded, parsed, EVENT_FEATURES)
    out = scored.select(text_io.scored_line(F.col("line"), F.col("prediction")).alias("value"))
    return _text_roundtrip(spark, out, "scored")


@register("nb_positional", f"""
WITH {SQL_EVENTS},
tr AS (SELECT id, y, hour, k, floor(value) AS value FROM ev),
{SQL_NB_FIT}, {SQL_NB_SCORED}
SELECT pred AS label, hour AS feture1, k AS feture2, value AS feture3 FROM best
""")
def nb_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed layout: train (id, label, hour, k, floor(value)) as ints,
    test (id, type, hour, k, value); result without id."""
    et = event_table(spark, sf_dir)
    train = et.select(
        "id", F.col("y").cast("int"), F.col("hour").cast("int"), F.col("k").cast("int"),
        F.floor("value").cast("int").alias("value"))
    test = et.select("id", "event_type", "hour", "k", "value")
    return bayes.naive_bayes_positional(train, test)


@register("decode_job_specs", """
SELECT CAST(event_id AS INTEGER) AS id, 'events_' || event_type AS train_table,
       'r' || CAST(event_id AS VARCHAR) AS result_table,
       json_extract_string(props, '$.k') AS k
FROM events
""")
def decode_job_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One base64 job spec per event (its props as operational_param), decoded."""
    ev = load(spark, sf_dir, "events")
    js = F.concat(F.lit('{"datasource": {"train_table": {"tablename": "events_'), F.col("event_type"),
                  F.lit('"}}, "output": {"result_table": {"tablename": "r'), F.col("event_id").cast("string"),
                  F.lit('"}}, "operational_param": '), F.col("props"), F.lit("}"))
    encoded = ev.select("event_id", specs.encode_spec(js).alias("spec"))
    spec = specs.require_spec(specs.decode_spec(F.col("spec")))
    return encoded.select(
        F.col("event_id").cast("int").alias("id"),
        F.try_element_at(spec.getField("datasource").getField("train_table"), F.lit("tablename")).alias("train_table"),
        F.try_element_at(spec.getField("output").getField("result_table"), F.lit("tablename")).alias("result_table"),
        specs.param(spec, "k").alias("k"))


@register("project_configured", """
SELECT CAST(event_id AS INTEGER) AS id, CAST(value AS DOUBLE) AS value, CAST(user_id AS DOUBLE) AS user_id,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
FROM events
""")
def project_configured_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured column list ``"value user_id k"`` -> id int + strict doubles
    (``k`` arrives as text and is parsed strictly)."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", "value", "user_id", F.get_json_object("props", "$.k").alias("k"))
    return project_configured(ev, "value user_id k".split(" "), id_col="event_id")


@register("train_test_split", """
SELECT CAST(event_id AS INTEGER) AS id, CASE WHEN event_id % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM events
""")
def train_test_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("int").alias("id"), split_flag(F.col("event_id")).alias("split"))


@register("preview", """
SELECT * FROM customer ORDER BY c_custkey LIMIT 20
""")
def preview_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 rows by key (the reference's ``show()``, made testable)."""
    return preview(load(spark, sf_dir, "customer"), "c_custkey", 20)


# ------------------------------------------------------------ result sinks
# The jobs' write modes on a file table in the shared folder: append twice
# keeps both copies, overwrite keeps one.  (A JDBC sink takes the same
# ``write_table`` call with a JDBC dict.)

def _sink_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer")
    sink = {"format": "parquet", "path": scratch_path(spark, f"sink-{mode}")}
    write_table(rows, sink, mode)
    write_table(rows, sink, mode)
    return read_table(spark, sink)


@register("sink_append_twice", """
SELECT * FROM customer UNION ALL SELECT * FROM customer
""")
def sink_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sink_twice(spark, sf_dir, "append")


@register("sink_overwrite", """
SELECT * FROM customer
""")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sink_twice(spark, sf_dir, "overwrite")


@register("sink_append_once", """
SELECT * FROM customer UNION ALL SELECT * FROM customer
""")
def sink_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, each appended once: one is repeated when done, the other fails
    between its steps, then is run again, twice."""
    rows = load(spark, sf_dir, "customer")
    path = scratch_path(spark, "sink-once")
    for _ in range(2):
        write_table(rows, {"path": path, "run_id": "first"}, "append")
    commit.stage(rows, path, "second")                       # and no commit
    for _ in range(2):
        write_table(rows, {"path": path, "run_id": "second"}, "append")
    return read_table(spark, {"path": path})


# --------------------------------------------------------- split reads
# The conditions that cut a JDBC read into parts, as SQL text on a view of the
# same rows: a part per condition, each row in one.

def _split_read(spark: SparkSession, rows: DataFrame, predicates: Callable[[str], list[str]]) -> DataFrame:
    view = "split_" + uuid.uuid4().hex
    rows.createOrReplaceTempView(view)
    parts = [spark.table(view).where(p).withColumn("part", F.lit(i)) for i, p in enumerate(predicates(view))]
    return reduce(DataFrame.unionByName, parts)


@register("read_split_depth", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 9 THEN o_custkey END AS k FROM orders),
c AS (SELECT DISTINCT min(k) AS cut FROM (SELECT k, ntile(8) OVER (ORDER BY k) AS tile FROM o WHERE k IS NOT NULL) s
      GROUP BY tile),
d AS (SELECT cut, row_number() OVER (ORDER BY cut) - 1 AS i FROM c)
SELECT o_orderkey, CAST(k AS DOUBLE) AS k,
       CAST(coalesce((SELECT max(i) FROM d WHERE cut <= k), 0) AS INTEGER) AS part FROM o
""")
def read_split_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in eight parts of about equally many rows by customer, NULLs in the first."""
    key = F.when(F.pmod("o_custkey", F.lit(10)) != 9, F.col("o_custkey").cast("double"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", key.alias("k"))

    def predicates(view: str) -> list[str]:
        cuts = spark.sql(splits.cut_query(view, "k", 8)).collect()
        return splits.depth_predicates("k", [r["cut"] for r in cuts], "spark")
    return _split_read(spark, orders, predicates)


@register("read_split_hash", """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_custkey % 10 <> 9 THEN o_custkey END AS k FROM orders
""")
def read_split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in eight parts by a hash of two columns, one with NULLs: every row once."""
    key = F.when(F.pmod("o_custkey", F.lit(10)) != 9, F.col("o_custkey"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", key.alias("k"))
    return _split_read(spark, orders, lambda view: splits.hash_predicates(["k", "o_orderpriority"], 8, "spark")).drop("part")


# Given centres on 64-dimensional embeddings: the mean vector of each
# label; every vector goes to the nearest mean (ties to the lowest label).

def label_mean_vectors(emb: DataFrame) -> tuple[list, list[list[float]]]:
    """(labels, centres): per-label mean of an array column, computed by a
    grouped aggregate over (label, position); k x dim rows reach the driver."""
    rows = (emb.select("label", F.posexplode("embedding").alias("i", "x"))
            .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c")).collect())
    by_label: dict = {}
    for r in rows:
        by_label.setdefault(r["label"], {})[r["i"]] = r["c"]
    labels = sorted(by_label)
    dim = max(len(v) for v in by_label.values())
    return labels, [[by_label[lb][i] for i in range(dim)] for lb in labels]


@register("kmeans_assign_embeddings", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
ce AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM e GROUP BY label, i),
lb AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM embeddings) s),
d AS (SELECT e.vec_id, ce.label AS cl,
             sum((CAST(e.x AS DOUBLE) - ce.c) * (CAST(e.x AS DOUBLE) - ce.c)) AS dist
      FROM e JOIN ce ON e.i = ce.i GROUP BY e.vec_id, ce.label),
r AS (SELECT vec_id, cl, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cl) AS rk FROM d)
SELECT CAST(r.vec_id AS INTEGER) AS id, CAST(lb.idx AS INTEGER) AS cluster, lb.label AS centre_label
FROM r JOIN lb ON r.cl = lb.label WHERE rk = 1
""")
def kmeans_assign_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = load(spark, sf_dir, "embeddings")
    labels, centres = label_mean_vectors(emb)
    idx = cluster.nearest_centre(F.col("embedding"), centres)
    out = emb.select(F.col("vec_id").cast("int").alias("id"), idx.alias("cluster"))
    return out.withColumn("centre_label", F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("cluster") + 1))
