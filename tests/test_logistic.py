"""Newton's logistic regression against Spark ML's, and its edges."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression

from hearth.operators import logistic
from hearth.operators.features import assemble


def _frame(spark, p=3, n=800):
    rng = np.random.default_rng(2)
    x = rng.normal(1, 2, (n, p))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ np.linspace(-1, 1, p) / np.sqrt(p) - 0.3)))).astype(float)
    cols = [f"x{i}" for i in range(p)]
    return spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{c} double" for c in [*cols, "y"])), cols


@pytest.mark.parametrize("p", [3, 30])
def test_reaches_the_ml_optimum(spark, p):
    df, cols = _frame(spark, p)
    fit = logistic.fit_logistic_newton(df, cols, "y", 8)
    ml = LogisticRegression(labelCol="y", maxIter=300, tol=1e-12).fit(assemble(df, cols))
    assert fit.coefficients == pytest.approx([ml.intercept, *ml.coefficients], abs=1e-5)
    assert len(fit.history) == 9 and fit.history[0][0] == pytest.approx(np.log(2)) and fit.history[-1][1] < 1e-9
    assert fit.rows == 800 and fit.history_frame(spark).count() == 9
    scored = df.select("y", fit.probability(cols).alias("p")).toPandas()
    assert scored["p"].mean() == pytest.approx(scored["y"].mean())


def test_both_sums_agree(spark, monkeypatch):
    df, cols = _frame(spark, 4)
    a = logistic.fit_logistic_newton(df, cols, "y", 5, reg=0.1)
    monkeypatch.setattr(logistic, "EXPRESSION_INPUTS", 0)
    b = logistic.fit_logistic_newton(df.repartition(3), cols, "y", 5, reg=0.1)
    assert a.coefficients == pytest.approx(b.coefficients) and np.allclose(a.history, b.history)


def test_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1), (2.0, 2.0, 0), (3.0, 3.0, 1), (None, 1.0, 1), (4.0, 4.0, None)],
                               "a double, b double, y int")
    fit = logistic.fit_logistic_newton(df, ["a", "b"], "y", 10)        # equal inputs: a singular Hessian
    assert fit.rows == 3 and fit.coefficients[1] == pytest.approx(fit.coefficients[2]) and fit.history[-1][1] < 1e-9
    apart = spark.createDataFrame([(float(k), int(k > 4)) for k in range(10)], "a double, y int")
    fit = logistic.fit_logistic_newton(apart, ["a"], "y", 12, reg=0.01)
    assert np.isfinite(fit.coefficients).all() and fit.history[-1][1] < 1e-9
    none = logistic.fit_logistic_newton(df.limit(0), ["a", "b"], "y", 3)
    assert none.coefficients == [0.0] * 3 and none.history == [] and none.rows == 0
