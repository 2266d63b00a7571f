"""Pair plots, co-missing columns, independent features, threshold samples and sketches."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import clean, profile, sampling


def test_pair_bins_equal_hist2d(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), int(b), None if k % 7 == 0 else float(c), 5.0) for k, (a, b, c) in
            enumerate(zip(rng.normal(size=300), rng.integers(0, 9, 300), rng.exponential(size=300)))]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double")
    got = {(r.feature_x, r.feature_y, r.bin_x, r.bin_y): r["count"] for r in profile.pair_bins(df, ["a", "b", "c", "d"], 6).collect()}
    want = {(x, y, r.bin_x, r.bin_y): r["count"] for x, y in combinations("abcd", 2)
            for r in profile.hist2d(df.filter(F.col(x).isNotNull()), x, y, 6, 6).collect()
            if not {x, y} & {"c"}}
    assert {k: v for k, v in got.items() if "c" not in k[:2]} == want
    assert sum(v for k, v in got.items() if k[:2] == ("a", "c")) == sum(r[2] is not None for r in rows)
    assert profile.pair_bins(df.limit(0), ["a", "b"]).count() == 0 and profile.pair_bins(df, ["a"]).count() == 0
    plan = profile.pair_bins(spark.range(9).select("id", (F.col("id") * 2).alias("x"), (F.col("id") * 3).alias("y")),
                             ["id", "x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0") == 1


def test_missing_patterns_and_pairs(spark):
    cols = [f"c{i}" for i in range(65)]        # more than one word of bits
    rng = np.random.default_rng(2)
    rows = []
    for k in range(200):
        r = [1] * 65
        if k % 3 == 0:
            r[0] = r[64] = None
        if rng.random() < 0.2:
            r[10] = None
        rows.append(tuple(r))
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    patterns = {tuple(r.features): r.n_rows for r in clean.missing_patterns(df).collect()}
    assert patterns == Counter(tuple(c for c, v in zip(cols, r) if v is None) for r in rows)
    pairs = {(r.feature_x, r.feature_y): r for r in clean.missing_together(clean.missing_patterns(df)).collect()}
    together = pairs["c0", "c64"]
    assert together.same_rows and together.both == 67 and together.only_x == together.only_y == 0
    other = pairs["c0", "c10"]
    assert not other.same_rows and other.both + other.only_x == 67
    assert clean.missing_together(clean.missing_patterns(df.select("c1", "c2"))).count() == 0


def test_independent_features_of_a_chain(spark):
    r = {("a", "b"): 0.9, ("b", "c"): 0.9, ("a", "c"): 0.5, ("d", "a"): 0.1}
    label = {"a": 0.5, "b": 0.6, "c": 0.55, "d": None}
    rows = [(x, y, v) for (x, y), v in r.items()] + [(y, x, v) for (x, y), v in r.items()]
    rows += [(f, "y", v) for f, v in label.items()] + [("y", "y", 1.0)]
    corr = spark.createDataFrame(rows, "feature_x string, feature_y string, corr double")
    got = {x.feature: (x.kept, x.because_of) for x in profile.independent_features(corr, "y", 0.8).collect()}
    assert got == {"a": (False, "b"), "b": (True, None), "c": (False, "b"), "d": (True, None)}
    label.update(b=0.1)         # the middle is the worst: both ends stay
    rows = [x for x in rows if x[1] != "y"] + [(f, "y", v) for f, v in label.items()]
    corr = spark.createDataFrame(rows, "feature_x string, feature_y string, corr double")
    got = {x.feature: x.kept for x in profile.independent_features(corr, "y", 0.8).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True}


@pytest.mark.parametrize("fraction, steps", [(0.75, 1 << 20), (0.75, 4), (0.3, 1), (0.0, 9), (1.0, 9), (0.001, 9)])
def test_exact_sample_is_the_smallest_draws(spark, fraction, steps):
    df = spark.range(500).select("id").repartition(3)
    draw = F.pmod(F.xxhash64("id"), F.lit(steps)) / steps
    rows = sampling.exact_sample(df, fraction, "id", 1, draw=draw).join(df.withColumn("u", draw), "id").collect()
    assert len(rows) == 500
    order = sorted(rows, key=lambda r: (r.u, r.id))
    assert [r.in_sample for r in order] == [k < int(fraction * 500) for k in range(500)]
    assert sampling.exact_sample(df.limit(0), 0.5, "id", 1).count() == 0


def test_sketch_quantiles_keep_their_rank_error(spark):
    n = 20_000
    df = spark.range(n).select(F.exp(F.randn(3) * 3).alias("skewed"), F.lit(None).cast("double").alias("none"),
                               F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id")).alias("hot")).cache()
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    for r in profile.sketch_quantiles(df, ["skewed", "none", "hot"], probs).collect():
        if r["column"] == "none":
            assert r.value is None
            continue
        low = df.filter(F.col(r["column"]) < r.value).count() / n
        high = df.filter(F.col(r["column"]) <= r.value).count() / n
        assert low - 2 * r.rank_error <= r.prob <= high + 2 * r.rank_error and r.rank_error < 0.011
    df.unpersist()
