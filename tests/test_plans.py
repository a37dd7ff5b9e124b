"""Plan regression tests: the physical properties the design relies on."""

from minekit.plans import catalog
from minekit.operators import fpm

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_naive_bayes_scoring_is_map_only_and_pruned(spark):
    plan = plan_of(catalog.QUERIES["nb_predict"](spark, SF))
    assert "Exchange" not in plan
    assert not any(node in plan for node in PYTHON_NODES)
    # user_id and event_type are not read by the scoring scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double,props:string>" in plan


def test_basket_build_aggregates_map_side(spark):
    plan = plan_of(catalog.order_baskets(spark, SF, "p_brand"))
    assert "partial_collect_set" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_ratings_build_aggregates_map_side(spark):
    plan = plan_of(catalog.cust_supp_ratings(spark, SF))
    assert "partial_avg" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan


def test_sgd_and_tree_prediction_are_map_only(spark):
    for name in ("linreg_predict", "dtree_predict"):
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert "Exchange" not in plan, name
        assert not any(node in plan for node in PYTHON_NODES), name


def test_assignment_to_given_centres_is_map_only(spark):
    plan = plan_of(catalog.QUERIES["kmeans_assign"](spark, SF))
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_rules_plan_has_no_python(spark):
    model = catalog._fp_model(spark, SF, "p_type", 0.05, 0.3)
    assert not any(node in plan_of(fpm.rule_text(model)) for node in PYTHON_NODES)
