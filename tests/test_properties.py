"""Property tests on random inputs (hypothesis), each checked against a
plain NumPy computation of the same definition."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hearth.operators import features, ranking, sampling

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.integers(-50, 50).map(float),
                            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=300)


@SETTINGS
@given(xs=values, probs=st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_quantiles_match_numpy(spark, xs, probs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = ranking.exact_quantiles(df, "x", probs, bins=8, max_fetch=16)
    want = np.quantile(np.array(xs), probs, method="linear")
    assert got == pytest.approx(list(want), rel=1e-9, abs=1e-9)


@SETTINGS
@given(xs=values, bounds=st.lists(st.integers(-60, 60).map(float), min_size=1, max_size=6,
                                  unique=True))
def test_bucket_index_is_searchsorted_right(spark, xs, bounds):
    b = sorted(bounds)
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(features.bucket_index("x", b)).collect()]
    assert got == list(np.searchsorted(np.array(b), np.array(xs), side="right"))


@SETTINGS
@given(xs=st.lists(st.integers(0, 5), min_size=0, max_size=200),
       parts=st.integers(1, 6))
def test_global_rank_is_a_sort(spark, xs, parts):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, v double")
    ranked, n = ranking.global_rank(df, ["v", "id"], num_partitions=parts)
    got = sorted((r.rank, r.id) for r in ranked.collect())
    want = [(k + 1, i) for k, (_, i) in enumerate(sorted((x, i) for i, x in enumerate(xs)))]
    assert n == len(xs) and got == want


@SETTINGS
@given(n=st.integers(0, 400), f=st.floats(0, 1), seed=st.integers(0, 1000))
def test_exact_sample_size_and_complement(spark, n, f, seed):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = sampling.exact_sample(df, f, "k", seed).collect()
    assert len(out) == n and sum(r.in_sample for r in out) == int(f * n)
    assert sorted(r.k for r in out) == list(range(n))


@SETTINGS
@given(xs=st.lists(st.floats(0, 1e9, allow_nan=False), min_size=1, max_size=100))
def test_expm1_inverts_log1p(spark, xs):
    from hearth.functions.scalar import expm1, log1p
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, back in df.select("x", expm1(log1p("x")).alias("b")).collect():
        assert back == pytest.approx(x, rel=1e-12, abs=1e-12)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 100).map(lambda k: k / 100)),
                     min_size=4, max_size=150))
def test_exact_auc_invariant_under_monotone_maps(spark, rows):
    # scores on a 0.01 grid, so the map below stays strictly increasing in
    # floating point too (a denormal score would cube to 0 and create a tie)
    from hearth.operators import metrics
    if len({y for y, _ in rows}) < 2:
        return
    df = spark.createDataFrame(rows, "y int, s double")
    a = metrics.roc_auc_exact(df, "y", "s")
    b = metrics.roc_auc_exact(df.withColumn("s", F.pow("s", 3) * 10 - 4), "y", "s")
    assert 0.0 <= a <= 1.0 and a == pytest.approx(b)
