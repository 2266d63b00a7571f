"""Trees grown together against Spark ML's fits, one by one."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from hearth.operators import bags, binned_trees, models, search


def _prepared(spark, n=2500, parts=3):
    """A nominal, a whole-number, a constant and two other features; rows that come twice."""
    rng = np.random.default_rng(8)
    kind, a, b, c = rng.integers(0, 40, n), rng.integers(0, 6, n), rng.normal(size=n).round(2), rng.exponential(size=n)
    y = np.sin(kind) * 3 + a * b + c + rng.normal(0, 0.5, n)
    rows = [(k // 2, f"k{kind[k // 2]}", int(a[k // 2]), float(b[k // 2]), float(c[k // 2]), float(y[k // 2]), k // 2 % 3)
            for k in range(n)]
    df = spark.createDataFrame(rows, "id long, s string, a int, b double, c double, label double, fold int")
    df = models.spread_for_fit(df.withColumn("same", F.lit(4.0)), ["id", "label"], parts)
    df = StringIndexer(inputCol="s", outputCol="kind").fit(df).transform(df)
    return VectorAssembler(inputCols=["kind", "a", "same", "b", "c"], outputCol="features").transform(df).select(
        "features", "label", "fold").persist()


def test_poisson_counts_are_commons_math(spark, monkeypatch):
    monkeypatch.setattr(bags, "ALONE", 2_000)
    monkeypatch.setattr(bags, "STEP_BITS", 9)
    monkeypatch.setattr(bags, "LANE_BITS", 3)
    monkeypatch.setattr(bags, "PIECE", 1_000)
    for seed in (8, -3, 2 ** 40 + 1):
        ml = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
        ml.reseedRandomGenerator(seed)
        want = list(ml.sample(6_000))
        stream = bags.PoissonStream(seed, 6_000)
        assert stream.take(0, 10).tolist() == want[:10]
        assert stream.take(5, 700).tolist() == want[5:700]
        assert stream.take(700, 6_000).tolist() == want[700:]      # several blocks of lanes


def test_node_draws_are_sparks(spark):
    jvm = spark._jvm
    for seed in (0, 7, -9, 2 ** 50):
        ml, own = jvm.org.apache.spark.util.random.XORShiftRandom(seed), bags.XorShift(seed)
        assert [ml.nextInt(), ml.nextDouble(), ml.nextInt()] == [own.next_int(), own.next_double(), own.next_int()]
        ml, own = jvm.java.util.Random(seed), bags.JavaRandom(seed)
        assert [ml.nextLong(), ml.nextLong()] == [own.next_long(), own.next_long()]
    assert sorted(bags.map_order(list(range(100)))) == list(range(100)) and bags.map_order([3, 1]) == [1, 3]


def test_all_fits_grow_together_and_equal_spark_ml(spark, monkeypatch):
    df = _prepared(spark)
    est = models.regressors(seed=5, max_bins=41)
    wanted = {"maxDepth=3,maxIter=1", "maxDepth=3,maxIter=4", "maxDepth=1,maxIter=5", "maxDepth=10", "maxDepth=5",
              "maxDepth=5,numTrees=15", "maxDepth=3,numTrees=5"}
    grid = [m for m in models.search_grid(Pipeline(stages=[]), est, "full") if models._describe_map(m)[1] in wanted]
    assert len(grid) == 7
    passes = []
    solve = binned_trees._solve
    with monkeypatch.context() as m:
        m.setattr(binned_trees, "_solve", lambda *a: passes.append(len(a[1])) or solve(*a))
        m.setattr(search, "_ensemble", lambda *a: pytest.fail("a fit of its own"))    # 5 fits a fold before
        together = search.shared_search(df, grid)
    assert len(passes) <= 12         # the levels of the longest chain, whatever the number of fits and folds
    monkeypatch.setattr(search, "_grows", lambda *a: False)
    assert together == pytest.approx(search.shared_search(df, grid), rel=1e-9)
    df.unpersist()


@pytest.mark.parametrize("kind, params", [("forest", {"numTrees": 5, "maxDepth": 4}), ("tree", {"maxDepth": 3}),
                                          ("boosted", {"maxDepth": 2, "maxIter": 3})])
def test_best_map_is_refitted_as_a_spark_ml_model(spark, monkeypatch, kind, params):
    df = _prepared(spark)
    est = models.regressors(seed=5, max_bins=41)[kind]
    want = est.copy({getattr(est, k): v for k, v in params.items()}).fit(df)
    with monkeypatch.context() as m:
        m.setattr(type(est), "fit", lambda *a: pytest.fail("a fit by Spark ML"))
        got = search.fit_map(df, kind, est, params)
    assert type(got) is type(want) and got.extractParamMap().keys() == want.extractParamMap().keys()
    both = zip(got.transform(df).select("prediction").collect(), want.transform(df).select("prediction").collect())
    assert all(a.prediction == pytest.approx(b.prediction, rel=1e-9) for a, b in both)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), rel=1e-9)
    df.unpersist()


def test_sampled_and_quantile_cuts_equal_spark_ml(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(z), float(x * 3 + z)) for x, z in zip(rng.normal(size=15_000), rng.integers(0, 3, 15_000))]
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(
        models.spread_for_fit(spark.createDataFrame(rows, "x double, z double, label double"), ["x"], 3)).persist()
    est = models.regressors(seed=2)["tree"]
    cuts = binned_trees.find_cuts(df, "features", 15_000, 2, 32, 2)
    model = est.copy({est.maxDepth: 4}).fit(df)
    used = {(f, t) for tree in search.tree_arrays(model) for f, t, at in zip(tree.feature, tree.threshold, tree.left) if at >= 0}
    assert used and used <= {(f, t) for f in (0, 1) for t in cuts.thresholds[f]} and len(cuts.thresholds[0]) > 20
    with pytest.raises(ValueError, match="rows to fit"):
        binned_trees.find_cuts(df, "features", 0, 2, 32, 2)
    df.unpersist()


def test_many_sums_take_several_passes(spark, monkeypatch):
    df = _prepared(spark)
    est = models.regressors(seed=5, max_bins=41)["tree"]
    want = search.fit_map(df, "tree", est, {"maxDepth": 4}).toDebugString
    sizes = []
    solve = binned_trees._solve
    monkeypatch.setattr(binned_trees, "SUMS_BYTES", 1)
    monkeypatch.setattr(binned_trees, "BLOCK_ROWS", 100)
    monkeypatch.setattr(binned_trees, "_solve", lambda *a: sizes.append(len(a[1])) or solve(*a))
    grid = [m for m in models.search_grid(Pipeline(stages=[]), {**models.regressors(seed=5, max_bins=41)}, "full")
            if models._describe_map(m)[0] == "DecisionTreeRegressor"]
    assert np.isfinite(search.shared_search(df, grid)).all() and set(sizes) == {1}
    assert len(search.fit_map(df, "tree", est, {"maxDepth": 4}).toDebugString) == len(want)
    df.unpersist()
