"""Kernel densities against the direct sum over all rows."""

import math

import numpy as np
import pytest

from hearth.operators import density, profile


def direct(values, grid, h):
    return np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2).sum(axis=1)


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


def heavy_tail():
    return np.random.default_rng(3).lognormal(0, 2, 3000)


@pytest.mark.parametrize("bandwidth", [None, 0.02, 50.0])
def test_density_equals_the_direct_sum(spark, bandwidth):
    v = heavy_tail()
    rows = profile.kde_grid(frame(spark, [*v, None]), "v", 64, bandwidth=bandwidth).orderBy("point").collect()
    h = bandwidth or v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 64)
    peak = 1 / (h * math.sqrt(2 * math.pi))
    assert [r.point for r in rows] == list(range(64))
    np.testing.assert_allclose([r.x for r in rows], grid, rtol=1e-9, atol=1e-9 * h)
    got = np.array([r.x for r in rows])
    np.testing.assert_allclose([r.density for r in rows], direct(v, got, h) * peak / len(v), rtol=0, atol=2e-13 * peak)


def test_fewer_terms_stay_within_their_bound(spark):
    v = np.random.default_rng(4).normal(size=2000)
    grid = -3 + 0.1 * np.arange(61)
    for terms in (4, 8, 12):
        got = density.gauss_sums(frame(spark, v), "v", -3.0, 0.1, 61, 0.3, terms=terms).orderBy("point").collect()
        worst = np.abs(np.array([r.total for r in got]) - direct(v, grid, 0.3)).max() / len(v)
        assert worst <= density.error_bound(terms) + 1e-15
    assert density.error_bound(18) < 1e-13 < density.error_bound(12)


def test_rows_out_of_reach_and_empty_tables(spark):
    far = frame(spark, [1e9, -1e9, float("nan"), None, 0.5])
    got = [r.total for r in density.gauss_sums(far, "v", 0.0, 1.0, 3, 0.25).orderBy("point").collect()]
    np.testing.assert_allclose(got, direct(np.array([0.5]), np.arange(3.0), 0.25), atol=1e-12)
    none = density.gauss_sums(frame(spark, [None]), "v", 0.0, 1.0, 3, 0.25).orderBy("point").collect()
    assert [r.total for r in none] == [0.0, 0.0, 0.0]


def test_box_count_does_not_grow_with_the_data(spark):
    from pyspark.sql import functions as F
    big = spark.range(20_000).select((F.col("id") * 10.0).alias("v"))
    plan = density.gauss_sums(big, "v", 0.0, 5000.0, 40, 1.0)
    assert plan.count() == 40
    total = plan.agg(F.sum("total")).first()[0]
    assert abs(total - 40) < 1e-9        # a point's neighbours are ten bandwidths away
