"""Plan-shape checks: the properties that matter at scale, read from the
physical plans of the registered queries."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

# queries that fit models are planned inside Spark ML; skip them here
MODEL = {"price_prediction", "lr_predict", "tree_predict", "rf_predict", "gbt_predict",
         "cv_leaderboard", "test_eval", "training_history", "model_roundtrip",
         "logistic_predict", "representation_compare", "resolution_sweep", "mlp_predict",
         "mlp_history", "mlp_topology", "lr_two_features", "lr_split_errors", "tree_stump"}
NAMES = sorted(n for n in E.queries() if n not in MODEL)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairing_joins_or_global_windows(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # a window without a partition spec would put every row in one task
    assert "Window [" not in plan or "SinglePartition" not in plan


def test_filter_pushdown_and_pruning(spark):
    df = E.queries()["zero_ids"](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount), EqualTo(l_discount,0.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan


def test_literal_exclusion_is_pushed(spark):
    plan = _plan(E.queries()["exclude_listed_ids"](spark, SF0001))
    assert "Not(In(c_custkey" in plan


def test_single_aggregate_for_profiles(spark):
    plan = _plan(E.queries()["corr_matrix"](spark, SF0001))
    assert plan.count("FileScan parquet") == 1
    # 100 thresholds: counted in the aggregate, not joined as a table; the
    # one join is labels with documents
    plan = _plan(E.queries()["auc_100"](spark, SF0001))
    assert plan.count("HashJoin") == 1


def test_bucketed_join_reads_without_exchange(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # the large-table case: no broadcast
    try:
        df = E.queries()["colocated_join"](spark, SF0001)
        plan = _plan(df)
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan
        assert df.count() == spark.read.parquet(f"{SF0001}/lineitem.parquet").count()
    finally:
        spark.conf.set(key, old)
