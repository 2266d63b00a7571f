"""Shared-work search, co-moments and exact trees against direct computation and Spark ML."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from hearth.functions.scalar import mix_number, mix_unit
from hearth.operators import comoments, exact_trees as et, models, profile, search
from hearth.operators.features import assemble


def _frame(spark, n=600, parts=4):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(5, 2, n), rng.integers(0, 6, n), rng.normal(0, 1, n)
    y = 2 * a - b + 0.3 * c * a + rng.normal(0, 0.5, n)
    rows = [(k, float(a[k]), float(b[k]), float(c[k]), float(y[k]), int(k % 3)) for k in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double, fold int").repartition(parts)


# ---------------------------------------------------------------- co-moments

def test_co_moments_match_numpy(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(1000, 1, (500, 70)) * rng.uniform(0.1, 5, 70)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 7.0
    key = rng.integers(0, 2, 500)
    cols = [f"c{i}" for i in range(70)]
    rows = [(int(k), *[None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)]) for k, r in zip(key, x)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = comoments.co_moments(df, cols, "k").collect()
    assert len(got) == 2 * 70 * 71 // 2
    for r in got[::37]:
        u, v = x[key == r.key][:, r.x], x[key == r.key][:, r.y]
        both = ~np.isnan(u) & ~np.isnan(v)
        u, v = u[both], v[both]
        assert r.n == both.sum() and r.mean_x == pytest.approx(u.mean()) and r.mean_y == pytest.approx(v.mean())
        for part, want in ((r.c_xx, (u - u.mean()) @ (u - u.mean())), (r.c_xy, (u - u.mean()) @ (v - v.mean()))):
            assert part == pytest.approx(want, rel=1e-9, abs=1e-7)
    wide = {(r.feature_x, r.feature_y): r.corr for r in profile.correlation_matrix(df.drop("k")).collect()}
    assert len(wide) == 70 * 70 and wide["c3", "c4"] is None and wide["c5", "c5"] == 1.0
    narrow = {(r.feature_x, r.feature_y): r.corr
              for r in profile.correlation_matrix(df.select([F.nanvl(c, F.lit(None)).alias(c) for c in cols[:9]])).collect()}
    assert all(wide[k] == (None if k[0] != k[1] and "c3" in k else pytest.approx(v, abs=1e-9)) for k, v in narrow.items())
    assert comoments.co_moments(df.limit(0), cols).count() == 0


def test_wide_correlation_is_one_scan(spark):
    df = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(60)])
    plan = profile.correlation_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0") == 1 and "CartesianProduct" not in plan


# ---------------------------------------------------------------- search

@pytest.mark.parametrize("reg, mix", [(0.001, 0.7), (0.05, 0.9), (0.5, 0.8), (0.1, 0.0)])
def test_elastic_net_reaches_the_ml_optimum(spark, reg, mix):
    df = _frame(spark)
    m = search.fold_moments(df, ["a", "b", "c", "label"], "fold")
    beta, b0 = search.elastic_net(search.pooled(list(m.values())), reg, mix, [500])[500]
    ml = LinearRegression(regParam=reg, elasticNetParam=mix, maxIter=500, tol=1e-12).fit(assemble(df, ["a", "b", "c"]))
    assert beta == pytest.approx(list(ml.coefficients), abs=1e-5) and b0 == pytest.approx(ml.intercept, abs=1e-4)
    rows = df.filter("fold = 1").toPandas()
    err = rows["label"] - b0 - rows[["a", "b", "c"]].to_numpy() @ beta
    assert search.held_out_rmse(m[1], beta, b0) == pytest.approx(math.sqrt((err ** 2).mean()))


def test_constant_columns_get_no_coefficient(spark):
    df = spark.createDataFrame([(1.0, float(k), 2.0 * k, k % 2) for k in range(20)], "a double, b double, y double, f int")
    m = search.fold_moments(df, ["a", "b", "y"], "f")
    beta, b0 = search.elastic_net(search.pooled(list(m.values())), 0.0, 0.5, [50])[50]
    assert beta == pytest.approx([0.0, 2.0]) and b0 == pytest.approx(0.0, abs=1e-9)
    flat = search.Moments(10.0, np.zeros(2), np.zeros((2, 2)))
    assert search.elastic_net(flat, 0.1, 0.5, [3])[3][0].tolist() == [0.0]


def test_shared_search_equals_one_fit_per_map(spark):
    df = assemble(models.spread_for_fit(_frame(spark), ["id"]), ["a", "b", "c"]).select("features", "label", "fold").persist()
    est, pipe = models.regressors(seed=3), Pipeline(stages=[])
    grid = [m for m in models.search_grid(pipe, est, "full")
            if models._describe_map(m) in {
                ("GBTRegressor", "maxDepth=2,maxIter=1"), ("GBTRegressor", "maxDepth=2,maxIter=4"),
                ("GBTRegressor", "maxDepth=3,maxIter=2"), ("DecisionTreeRegressor", "maxDepth=2"),
                ("DecisionTreeRegressor", "maxDepth=5"), ("RandomForestRegressor", "maxDepth=3,numTrees=10"),
                ("RandomForestRegressor", "maxDepth=2,numTrees=5"),
                ("LinearRegression", "elasticNetParam=0.7,maxIter=30,regParam=0.01")}]
    assert len(grid) == 8
    shared = search.shared_search(df, grid).mean(axis=1)
    single = models.cross_validate(df, pipe, grid, folds=3, fold_col="fold").avgMetrics
    for m, a, b in zip(grid, shared, single):
        kind = models._describe_map(m)
        if kind[0] == "RandomForestRegressor" and "numTrees=5" in kind[1]:
            # the first five trees of the forest of ten, cut one level higher: not the forest drawn alone
            assert a == pytest.approx(b, rel=0.35)
        else:
            assert a == pytest.approx(b, rel=1e-4 if kind[0] == "LinearRegression" else 1e-9), kind
    df.unpersist()


def test_categorical_splits_are_looked_up_for_all_rows_at_once(monkeypatch):
    rng = np.random.default_rng(2)
    inner, n = 127, 255
    own = np.arange(n)
    feature = np.where(own < inner, rng.integers(0, 3, n), 0)
    left = np.where((own < inner) & (own != 5), 2 * own + 1, -1)
    categories = {k: np.flatnonzero(rng.random(9) < 0.5).astype(float) for k in range(inner) if feature[k] and left[k] >= 0}
    tree = search.Tree(feature, rng.normal(size=n), left, np.where(left >= 0, left + 1, -1), rng.normal(size=n), categories)
    x = np.column_stack([rng.normal(size=500), rng.integers(-2, 14, 500), rng.integers(0, 9, 500)]).astype(float)
    x[::50, 1], x[1::50, 2], x[2::50, 0], x[3::50, 1] = np.nan, 2.5, np.nan, np.inf

    def walk(row, depth):
        node = 0
        for _ in range(depth):
            if left[node] < 0:
                break
            v = row[feature[node]]
            go = v in categories[node] if node in categories else v <= tree.threshold[node]
            node = left[node] + (not go)
        return tree.prediction[node]
    want = {d: [walk(row, d) for row in x] for d in (0, 2, 7)}
    # once per split and level, this took most of the time of deep trees
    monkeypatch.setattr(np, "isin", lambda *a, **k: pytest.fail("a pass over the rows for one node"))
    got = tree.by_depth(x, [0, 2, 7])
    assert {d: v.tolist() for d, v in got.items()} == want


def test_errors_score_many_batches_together(monkeypatch):
    calls = []
    monkeypatch.setattr(search.Ensemble, "predictions", lambda self, x: calls.append(len(x)) or iter([(0, x[:, 0])]))
    ensemble = search.Ensemble([], [], False, [])
    batches = [pa.RecordBatch.from_arrays([pa.array([k % 2] * 3, pa.int32()), pa.array([[1.0], [2.0], [3.0]]),
                                           pa.array([1.0, 1.0, 1.0])], ["fold", "x", "y"]) for k in range(40)]
    out, = search._errors({0: [ensemble], 1: [ensemble]})(batches)
    assert calls == [60, 60]
    assert out.to_pylist() == [{"map": 0, "fold": f, "n": 60, "sse": 100.0} for f in (0, 1)]
    assert list(search._errors({0: [ensemble]})([])) == []


def test_rank_maps_is_best_first(spark):
    est, pipe = models.regressors(), Pipeline(stages=[])
    grid = models.search_grid(pipe, est, "smoke")
    board = models.rank_maps(spark, grid, [5, 4, 3, 2, 1, 0.5], [0.0] * 6).collect()
    assert [r["rank"] for r in board] == list(range(1, 7)) and [r.avg_metric for r in board] == [0.5, 1, 2, 3, 4, 5]


def test_partitions_follow_from_the_rows():
    assert [models.fit_partitions(n) for n in (0, 10, 60_001, 480_000, 10 ** 7, 32_000_001, 10 ** 10)] == [
        1, 1, 2, 8, 32, 33, 10_000]


# ---------------------------------------------------------------- exact trees

def test_mix_number_is_mix_unit(spark):
    keys = [0, 1, 7, 2 ** 31 - 1, 2 ** 31, 2 ** 40 + 5, 2 ** 62]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", mix_unit("k", 9).alias("u"))
    assert all(mix_number(r.k, 9) == r.u for r in df.collect())


def slow_tree(x, y, w, depth, min_rows=1, allowed=None):
    """{node: (feature, threshold)} and {node: mean}, one node at a time."""
    splits, means = {}, {}

    def grow(node, at):
        n, s = w[at].sum(), (w * y)[at].sum()
        means[node] = s / n
        if node >= 2 ** depth:
            return
        best = None
        for f in range(x.shape[1]) if allowed is None else allowed(node):
            v = x[at, f]
            known = np.unique(v[~np.isnan(v)])
            for a, b in zip(known, known[1:]):
                left = at[(x[at, f] <= a)]
                nl, sl = w[left].sum(), (w * y)[left].sum()
                if nl < min_rows or n - nl < min_rows:
                    continue
                gain = round((sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n) / (w * y * y)[at].sum(), 10)
                if best is None or gain > best[0]:
                    best = gain, f, (a + b) / 2
        if best and best[0] > 1e-9:
            splits[node] = best[1:]
            go = x[at, best[1]] <= best[2]
            grow(2 * node, at[go])
            grow(2 * node + 1, at[~go])
    grow(1, np.flatnonzero(w > 0))
    return splits, means


@pytest.mark.parametrize("min_rows, buckets", [(1, 64), (20, 3)])
def test_exact_tree_matches_brute_force(spark, monkeypatch, min_rows, buckets):
    monkeypatch.setattr(et, "BUCKETS", buckets)
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 4, 300), rng.integers(0, 2, 300)]).astype(float)
    y = x[:, 0] * 3 + (x[:, 1] == 2) * 5 + rng.normal(0, 0.1, 300)
    x[rng.random(x.shape) < 0.1] = np.nan
    w = rng.integers(0, 3, 300).astype(float)
    df = spark.createDataFrame([(*[None if np.isnan(v) and k % 2 else float(v) for v in r], float(t), int(c))
                                for k, (r, t, c) in enumerate(zip(x, y, w))], "a double, b double, c double, y double, w int")
    tree, = et.fit_exact_trees(df, ["a", "b", "c"], "y", 3, min_rows=min_rows, weights=lambda t: F.col("w"))
    splits, means = slow_tree(x, y, w, 3, min_rows)
    got = {n: (f, tree.threshold[n]) for n, f in enumerate(tree.feature) if f >= 0}
    assert got == splits
    assert {n: m for n, m in enumerate(tree.prediction) if not math.isnan(m)} == pytest.approx(means)
    node = df.select(et.node_of(tree, et._features(["a", "b", "c"])).alias("n"), "w").collect()
    assert all(r.n not in splits for r in node)


def test_forest_uses_bags_and_drawn_features(spark):
    df = _frame(spark).cache()
    trees = et.fit_exact_trees(df, ["a", "b", "c"], "label", 2, n_trees=3, features_per_node=1, seed=4, bag_key="id")
    rows = df.select("a", "b", "c", "label", *[et.bag_weight(et.bag_draw("id", t, 4)).alias(f"w{t}") for t in range(3)]).toPandas()
    x = rows[["a", "b", "c"]].to_numpy()
    for t, tree in enumerate(trees):
        w = rows[f"w{t}"].to_numpy().astype(float)
        assert 0.8 < w.mean() < 1.2
        splits, means = slow_tree(x, rows["label"].to_numpy(), w, 2, allowed=lambda n: et._allowed(t, n, 3, 1, 4))
        assert {n: (f, tree.threshold[n]) for n, f in enumerate(tree.feature) if f >= 0} == splits
    df.unpersist()


def test_exact_trees_equal_spark_ml_when_its_bins_hold_all_values(spark):
    df = _frame(spark).select("id", F.round("a").alias("a"), "b", F.round(F.col("c") * 3).alias("c"), "label").cache()
    tree, = et.fit_exact_trees(df, ["a", "b", "c"], "label", 3)
    ml = DecisionTreeRegressor(maxDepth=3, maxBins=64).fit(assemble(df, ["a", "b", "c"]))
    both = ml.transform(assemble(df, ["a", "b", "c"])).select(
        "prediction", et.predicted(tree, et._features(["a", "b", "c"])).alias("p")).collect()
    assert all(r.p == pytest.approx(r.prediction) for r in both)
    trees = et.fit_exact_boosted(df, ["a", "b", "c"], "label", 2, 3, step=0.1)
    ml = GBTRegressor(maxDepth=2, maxIter=3, maxBins=64, stepSize=0.1).fit(assemble(df, ["a", "b", "c"]))
    both = ml.transform(assemble(df, ["a", "b", "c"])).select(
        "prediction", et.boosted_prediction(trees, ["a", "b", "c"], 0.1).alias("p")).collect()
    assert all(r.p == pytest.approx(r.prediction) for r in both)
    df.unpersist()


def test_exact_tree_edges(spark):
    none = spark.createDataFrame([], "a double, y double")
    tree, = et.fit_exact_trees(none, ["a"], "y", 2)
    assert math.isnan(tree.prediction[1]) and tree.feature == [-1]
    same = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0), (None, 4.0), (2.0, None)], "a double, y double")
    tree, = et.fit_exact_trees(same, ["a"], "y", 2)
    assert tree.prediction[1] == 4.0 and all(f < 0 for f in tree.feature)
    flat = spark.createDataFrame([(float(k), 0.0) for k in range(5)], "a double, y double")
    tree, = et.fit_exact_trees(flat, ["a"], "y", 2)
    assert tree.prediction[1] == 0.0 and all(f < 0 for f in tree.feature)
