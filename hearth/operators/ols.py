"""Closed-form simple least squares with inference.

All sums come from one aggregate of SQL ``regr_*`` functions (partial
aggregation everywhere, a one-row final). Standard errors, t and F tests
follow R's ``summary.lm``; tail probabilities are driver-side scalars.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql.types import DoubleType
from pyspark.sql import DataFrame, functions as F

from hearth.functions.distributions import f_sf, t_quantile, t_two_sided_p
from hearth.operators.ranking import column_quantiles
from hearth.session import ship_package


@dataclass
class SimpleOLS:
    y: str
    x: str
    n: int
    intercept: float
    slope: float
    sxx: float
    syy: float
    sxy: float
    avgx: float
    avgy: float

    @property
    def df_resid(self) -> int:
        return self.n - 2

    @property
    def rss(self) -> float:
        return max(self.syy - self.slope * self.sxy, 0.0)

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_resid if self.df_resid > 0 else float("nan")

    def se_slope(self) -> float:
        return math.sqrt(self.sigma2 / self.sxx) if self.sxx > 0 else float("nan")

    def se_intercept(self) -> float:
        if self.sxx <= 0 or self.n == 0:
            return float("nan")
        return math.sqrt(self.sigma2 * (1.0 / self.n + self.avgx ** 2 / self.sxx))

    def r2(self) -> float:
        return 1.0 - self.rss / self.syy if self.syy > 0 else float("nan")


def fit_simple_ols(df: DataFrame, y: str, x: str) -> SimpleOLS:
    """y ~ x by ordinary least squares (F16). Rows with a null in x or y are
    skipped (the ``regr_*`` contract, R's ``na.omit``)."""
    r = _sums(df, y, x).first()
    nan = float("nan")
    return SimpleOLS(y, x, int(r["n"] or 0), r["a"] if r["a"] is not None else nan,
                     r["b"] if r["b"] is not None else nan,
                     r["sxx"] or 0.0, r["syy"] or 0.0, r["sxy"] or 0.0,
                     r["ax"] if r["ax"] is not None else nan,
                     r["ay"] if r["ay"] is not None else nan)


def _sums(df: DataFrame, y: str, x: str) -> DataFrame:
    """One-row frame of the least-squares sums (one aggregate)."""
    ship_package(df.sparkSession)  # the t/F tail UDFs below run in Python workers
    return df.agg(F.regr_count(y, x).alias("n"), F.regr_intercept(y, x).alias("a"),
                  F.regr_slope(y, x).alias("b"), F.regr_sxx(y, x).alias("sxx"),
                  F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
                  F.regr_avgx(y, x).alias("ax"), F.regr_avgy(y, x).alias("ay"))


@F.pandas_udf(DoubleType())
def _t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(float(a), float(b)) if pd.notna(a) else None
                      for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def _t_quantile(p: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(float(a), float(b)) for a, b in zip(p, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def _f_upper(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(float(a), float(b), float(c)) if pd.notna(a) else None
                      for a, b, c in zip(f, d1, d2)], dtype="float64")


def _se_cols():
    dof = F.col("n") - 2
    s2 = F.try_divide(F.col("syy") - F.col("b") * F.col("sxy"), dof)
    se_b = F.sqrt(F.try_divide(s2, F.col("sxx")))
    se_a = F.sqrt(s2 * (F.try_divide(F.lit(1.0), F.col("n"))
                        + F.try_divide(F.col("ax") * F.col("ax"), F.col("sxx"))))
    return dof, s2, se_a, se_b


def coefficient_table(df: DataFrame, y: str, x: str) -> DataFrame:
    """(term, estimate, std_error, t_value, p_value) like ``summary(lm)``.

    Estimates and standard errors are Column arithmetic on the one-row
    aggregate; the two-sided t probability is a small Pandas UDF applied
    to the two result rows.
    """
    dof, _, se_a, se_b = _se_cols()
    rows = _sums(df, y, x).select(dof.alias("dof"), F.explode(F.array(
        F.struct(F.lit("(Intercept)").alias("term"), F.col("a").alias("estimate"),
                 se_a.alias("std_error")),
        F.struct(F.lit(x).alias("term"), F.col("b").alias("estimate"),
                 se_b.alias("std_error")))).alias("c"))
    out = rows.select("dof", "c.term", "c.estimate", "c.std_error",
                      F.try_divide(F.col("c.estimate"), F.col("c.std_error")).alias("t_value"))
    return out.select("term", "estimate", "std_error", "t_value",
                      _t_two_sided(F.col("t_value"), F.col("dof").cast("double")).alias("p_value"))


def fit_statistics(df: DataFrame, fit: SimpleOLS) -> DataFrame:
    """Model-level summary (F17): residual quantiles, residual standard
    error, R^2, adjusted R^2, F statistic and its p-value.

    Residual quantiles come from the exact distributed selection; the rest
    is Column arithmetic on the one-row aggregate.
    """
    res = df.where(F.col(fit.y).isNotNull() & F.col(fit.x).isNotNull()) \
            .select((F.col(fit.y) - (F.lit(fit.intercept) + F.lit(fit.slope) * F.col(fit.x)))
                    .alias("resid"))
    qs = column_quantiles(res, ["resid"], [0.0, 0.25, 0.5, 0.75, 1.0])["resid"]
    dof, s2, _, _ = _se_cols()
    rss = F.col("syy") - F.col("b") * F.col("sxy")
    r2 = 1.0 - F.try_divide(rss, F.col("syy"))
    adj = 1.0 - F.try_divide(rss, F.col("syy")) * F.try_divide(F.col("n") - 1, dof)
    fstat = F.try_divide(r2, 1.0 - r2) * dof
    one = _sums(df, fit.y, fit.x).select(
        "n", dof.alias("df_resid"),
        *[F.lit(v).cast("double").alias(nm) for v, nm in zip(
            qs, ("resid_min", "resid_q1", "resid_median", "resid_q3", "resid_max"))],
        F.sqrt(s2).alias("sigma"), r2.alias("r_squared"), adj.alias("adj_r_squared"),
        fstat.alias("f_statistic"))
    return one.withColumn("f_p_value", _f_upper(F.col("f_statistic"), F.lit(1.0),
                                                F.col("df_resid").cast("double")))


def confint(df: DataFrame, y: str, x: str, level: float = 0.95) -> DataFrame:
    """Coefficient confidence intervals, estimate +- t(1-a/2, n-2) se (F18),
    from the one-row aggregate; the t quantile is a small Pandas UDF."""
    dof, _, se_a, se_b = _se_cols()
    one = _sums(df, y, x).select(
        _t_quantile(F.lit(0.5 + level / 2.0), dof.cast("double")).alias("tq"),
        F.explode(F.array(
            F.struct(F.lit("(Intercept)").alias("term"), F.col("a").alias("estimate"),
                     se_a.alias("se")),
            F.struct(F.lit(x).alias("term"), F.col("b").alias("estimate"),
                     se_b.alias("se")))).alias("c"))
    return one.select("c.term", F.lit(float(level)).alias("level"),
                      (F.col("c.estimate") - F.col("tq") * F.col("c.se")).alias("lower"),
                      (F.col("c.estimate") + F.col("tq") * F.col("c.se")).alias("upper"))


def fitted_line(df: DataFrame, fit: SimpleOLS) -> DataFrame:
    """Two points of the fitted line at min(x) and max(x)."""
    ends = df.agg(F.min(fit.x).alias("lo"), F.max(fit.x).alias("hi"))
    pts = ends.select(F.explode(F.array(F.col("lo").cast("double"), F.col("hi").cast("double")))
                      .alias("x"))
    return pts.select("x", (F.lit(fit.intercept) + F.lit(fit.slope) * F.col("x")).alias("y_hat"))


def predict(df: DataFrame, fit: SimpleOLS, out: str = "prediction") -> DataFrame:
    """Score rows with the fitted line."""
    return df.withColumn(out, F.lit(fit.intercept) + F.lit(fit.slope) * F.col(fit.x))
