"""The registered model queries on the smallest tables: shapes and
invariants that must hold whatever the fitted numbers are."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF0001
from hearth.functions.scalar import mix_unit
from hearth.sources.tables import table

Q = E.queries()


def _held_out_lines(spark):
    l = table(spark, SF0001, "lineitem")
    return l.filter(mix_unit("l_orderkey", 7) >= 0.8).count()


def test_predictions_cover_held_out_rows(spark):
    n = _held_out_lines(spark)
    for name in ("price_prediction", "lr_predict", "gbt_predict"):
        rows = Q[name](spark, SF0001).collect()
        assert len(rows) == n
        assert all(math.isfinite(r[-1]) for r in rows)


def test_leaderboard_sorted(spark):
    rows = Q["cv_leaderboard"](spark, SF0001).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(1, 109))     # the whole grid
    assert [r.avg_metric for r in rows] == sorted(r.avg_metric for r in rows)
    assert {r.estimator for r in rows} == {"LinearRegression", "DecisionTreeRegressor",
                                           "RandomForestRegressor", "GBTRegressor"}


def test_logistic_predict_beats_majority_on_held_out_rows(spark):
    df = Q["logistic_predict"](spark, SF0001).cache()
    assert df.count() == spark.read.parquet(f"{SF0001}/documents.parquet").count()
    test = [r for r in df.filter("split = 'test'").collect()]
    right = sum(r.predicted == r.quality for r in test) / len(test)
    majority = max(sum(r.quality == k for r in test) for k in (0, 1)) / len(test)
    assert right > majority
    assert df.filter("p_quality < 0 or p_quality > 1 or p_quality is null").count() == 0


def test_histories_and_comparisons(spark):
    hist = [r.value for r in Q["training_history"](spark, SF0001).orderBy("epoch").collect()]
    assert hist and hist[-1] <= hist[0]
    comp = Q["representation_compare"](spark, SF0001).collect()
    assert {r.representation for r in comp} == {"float", "buckets", "cross"}
    assert all(math.isfinite(r.train_rmse) and math.isfinite(r.test_rmse) for r in comp)
    mlp = Q["mlp_history"](spark, SF0001).collect()
    assert [r.metric for r in mlp].count("mse") == 140 and len(mlp) == 141
    assert all(math.isfinite(r.value) for r in mlp)
