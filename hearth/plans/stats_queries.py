"""Queries for least squares inference and evaluation metrics (F16-F19, I18, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators import metrics, ols
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 111
_LDRAW = mix_unit_sql("l_orderkey", SEED)


def _li(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                              "l_extendedprice")


_OLS_SQL = """
s AS (SELECT regr_count(l_extendedprice, l_quantity) AS n,
             regr_intercept(l_extendedprice, l_quantity) AS a,
             regr_slope(l_extendedprice, l_quantity) AS b,
             regr_sxx(l_extendedprice, l_quantity) AS sxx,
             regr_syy(l_extendedprice, l_quantity) AS syy,
             regr_sxy(l_extendedprice, l_quantity) AS sxy,
             regr_avgx(l_extendedprice, l_quantity) AS ax FROM lineitem),
e AS (SELECT *, (syy - b * sxy) / (n - 2) AS s2 FROM s)"""


@query("ols_fit", "F16", f"""
WITH {_OLS_SQL.strip()}
SELECT '(Intercept)' AS term, round(a, 6) AS estimate FROM e
UNION ALL SELECT 'l_quantity', round(b, 6) FROM e
""")
def ols_fit(spark, d):
    """price ~ quantity: intercept and slope."""
    tab = ols.coefficient_table(_li(spark, d), "l_extendedprice", "l_quantity")
    return tab.select("term", F.round("estimate", 6).alias("estimate"))


@query("ols_inference", "F17", f"""
WITH {_OLS_SQL.strip()}
SELECT '(Intercept)' AS term, round(a, 6) AS estimate,
       round(sqrt(s2 * (1.0 / n + ax * ax / sxx)), 6) AS std_error,
       round(a / sqrt(s2 * (1.0 / n + ax * ax / sxx)), 6) AS t_value FROM e
UNION ALL
SELECT 'l_quantity', round(b, 6), round(sqrt(s2 / sxx), 6), round(b / sqrt(s2 / sxx), 6) FROM e
""")
def ols_inference(spark, d):
    """Estimates with standard errors and t statistics."""
    tab = ols.coefficient_table(_li(spark, d), "l_extendedprice", "l_quantity")
    return tab.select("term", *[F.round(c, 6).alias(c) for c in ("estimate", "std_error", "t_value")])


# Two-sided t tail with no special function: t = sqrt(df) tan(u) turns the density into
# cos(u)^(df-1), integrated by Simpson's rule over the tail and over the whole half line.
_PVALUE_SQL = """
ts AS (SELECT n - 2 AS df, '(Intercept)' AS term, a / sqrt(s2 * (1.0 / n + ax * ax / sxx)) AS t_value FROM e
       UNION ALL SELECT n - 2, 'l_quantity', b / sqrt(s2 / sxx) FROM e),
half AS (SELECT df, term, t_value, atan(abs(t_value) / sqrt(df)) AS u0,
                least(pi() / 2, 60 / sqrt(df)) AS u1 FROM ts),
w AS (SELECT i / 200000.0 AS x, CASE WHEN i % 200000 = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
      FROM range(200001) r(i)),
p AS (SELECT term, t_value,
             sum(w * cos(least(u0, u1) + (u1 - least(u0, u1)) * x) ** (df - 1)) * (u1 - least(u0, u1))
             / (sum(w * cos(u1 * x) ** (df - 1)) * u1) AS p_value
      FROM half, w GROUP BY term, t_value, u0, u1, df)"""


@query("ols_pvalues", "F17", f"""
WITH {_OLS_SQL.strip()}, {_PVALUE_SQL.strip()}
SELECT term, round(t_value, 6) AS t_value, round(p_value, 9) AS p_value FROM p
""")
def ols_pvalues(spark, d):
    """Two-sided p-values of the coefficients (t distribution)."""
    tab = ols.coefficient_table(_li(spark, d), "l_extendedprice", "l_quantity")
    return tab.select("term", F.round("t_value", 6).alias("t_value"), F.round("p_value", 9).alias("p_value"))


@query("ols_summary", "F17", f"""
WITH {_OLS_SQL.strip()},
res AS (SELECT l_extendedprice - (a + b * l_quantity) AS r FROM lineitem, e)
SELECT n::BIGINT AS n, (n - 2)::BIGINT AS df_resid,
       round((SELECT min(r) FROM res), 4) AS resid_min,
       round((SELECT quantile_cont(r, 0.25) FROM res), 4) AS resid_q1,
       round((SELECT quantile_cont(r, 0.5) FROM res), 4) AS resid_median,
       round((SELECT quantile_cont(r, 0.75) FROM res), 4) AS resid_q3,
       round((SELECT max(r) FROM res), 4) AS resid_max,
       round(sqrt(s2), 6) AS sigma, round(1 - (syy - b * sxy) / syy, 9) AS r_squared,
       round(1 - ((syy - b * sxy) / syy) * (n - 1) / (n - 2), 9) AS adj_r_squared,
       round((1 - (syy - b * sxy) / syy) / ((syy - b * sxy) / syy) * (n - 2), 6) AS f_statistic
FROM e
""")
def ols_summary(spark, d):
    """Residual quantiles, residual standard error, R^2, adjusted R^2, F."""
    li = _li(spark, d)
    fit = ols.fit_simple_ols(li, "l_extendedprice", "l_quantity")
    st = ols.fit_statistics(li, fit)
    return st.select("n", "df_resid",
                     *[F.round(c, 4).alias(c) for c in ("resid_min", "resid_q1", "resid_median",
                                                         "resid_q3", "resid_max")],
                     F.round("sigma", 6).alias("sigma"), F.round("r_squared", 9).alias("r_squared"),
                     F.round("adj_r_squared", 9).alias("adj_r_squared"),
                     F.round("f_statistic", 6).alias("f_statistic"))


# The normal quantile at 0.975 (published value) expanded in powers of 1/df to the t quantile.
_Z = 1.959963984540054
_TQ_SQL = (f"({_Z} + {(_Z**3 + _Z) / 4} / (n - 2) + {(5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96} / (n - 2) ** 2"
           f" + {(3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384} / (n - 2) ** 3)")


@query("ols_confint", "F18", f"""
WITH {_OLS_SQL.strip()},
c AS (SELECT '(Intercept)' AS term, a AS est, {_TQ_SQL} * sqrt(s2 * (1.0 / n + ax * ax / sxx)) AS half FROM e
      UNION ALL SELECT 'l_quantity', b, {_TQ_SQL} * sqrt(s2 / sxx) FROM e)
SELECT term, 0.95::DOUBLE AS level, round(est - half, 6) AS lower, round(est + half, 6) AS upper FROM c
""")
def ols_confint(spark, d):
    """95% confidence intervals (t quantile)."""
    ci = ols.confint(_li(spark, d), "l_extendedprice", "l_quantity", 0.95)
    return ci.select("term", "level", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query("fitted_line", "F19", f"""
WITH {_OLS_SQL.strip()},
ends AS (SELECT min(l_quantity)::DOUBLE AS x FROM lineitem
         UNION ALL SELECT max(l_quantity)::DOUBLE FROM lineitem)
SELECT x, round(a + b * x, 6) AS y_hat FROM ends, e
""")
def fitted_line(spark, d):
    """The fitted line at the smallest and largest quantity."""
    li = _li(spark, d)
    fit = ols.fit_simple_ols(li, "l_extendedprice", "l_quantity")
    return ols.fitted_line(li, fit).withColumn("y_hat", F.round("y_hat", 6))


_SPLIT_SQL = f"""
sp AS (SELECT *, CASE WHEN {_LDRAW} < 0.75 THEN 'train' ELSE 'test' END AS split FROM lineitem),
tf AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a,
              regr_slope(l_extendedprice, l_quantity) AS b FROM sp WHERE split = 'train'),
scored AS (SELECT sp.*, a + b * l_quantity AS pred FROM sp, tf)"""


def _split_scored(spark, d):
    li = _li(spark, d).withColumn("split", F.when(mix_unit("l_orderkey", SEED) < 0.75, "train")
                                            .otherwise("test"))
    fit = ols.fit_simple_ols(li.filter(F.col("split") == "train"), "l_extendedprice", "l_quantity")
    return ols.predict(li, fit, "pred")


@query("ols_predict", "I18,J1,J2,J9", f"""
WITH {_SPLIT_SQL.strip()}
SELECT count(*) AS n, round(avg(power(l_extendedprice - pred, 2)), 2) AS mse,
       round(sqrt(avg(power(l_extendedprice - pred, 2))), 6) AS rmse,
       round(avg(abs(l_extendedprice - pred)), 6) AS mae
FROM scored WHERE split = 'test'
""")
def ols_predict(spark, d):
    """Fit on the training orders, score held-out orders: n, MSE, RMSE, MAE."""
    sc = _split_scored(spark, d).filter(F.col("split") == "test")
    m = metrics.regression_metrics(sc, "l_extendedprice", "pred")
    return m.select("n", F.round("mse", 2).alias("mse"), F.round("rmse", 6).alias("rmse"),
                    F.round("mae", 6).alias("mae"))


@query("ols_residuals", "J11", f"""
WITH {_SPLIT_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, round(pred, 6) AS predicted,
       round(l_extendedprice - pred, 6) AS residual
FROM scored WHERE split = 'test'
""")
def ols_residuals(spark, d):
    """Actual, predicted and residual for every held-out row."""
    sc = _split_scored(spark, d).filter(F.col("split") == "test")
    r = metrics.residuals(sc, ["l_orderkey", "l_linenumber"], "l_extendedprice", "pred")
    return r.withColumns({"predicted": F.round("predicted", 6),
                          "residual": F.round("residual", 6)})


@query("overfit_gap", "J10", f"""
WITH {_SPLIT_SQL.strip()}
SELECT split, count(*) AS n, round(avg(power(l_extendedprice - pred, 2)), 2) AS mse,
       round(sqrt(avg(power(l_extendedprice - pred, 2))), 6) AS rmse
FROM scored GROUP BY split
""")
def overfit_gap(spark, d):
    """Train vs test error of the same fit."""
    e = metrics.split_errors(_split_scored(spark, d), "split", "l_extendedprice", "pred")
    return e.select("split", "n", F.round("mse", 2).alias("mse"), F.round("rmse", 6).alias("rmse"))


# A deterministic score for threshold metrics: a logistic of the z-scored
# log document length, judged against the quality label.
_SCORE_SQL = """
j AS (SELECT l.doc_id, l.quality, ln(1 + d.n_chars) AS x FROM labels l JOIN documents d USING (doc_id)),
st AS (SELECT avg(x) AS m, stddev_samp(x) AS sd FROM j),
sc AS (SELECT doc_id, quality, 1 / (1 + exp(-((x - m) / sd))) AS score FROM j, st)"""


def _scored_docs(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "quality")
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id").select("doc_id", "quality",
                                         F.log1p(F.col("n_chars").cast("double")).alias("x"))
    st = j.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("sd")).first()
    return j.select("doc_id", "quality",
                    (1 / (1 + F.exp(-((F.col("x") - st["m"]) / st["sd"])))).alias("score"))


def _sweep_sql(ts):
    rows = []
    for t in ts:
        rows.append(f"""SELECT {t!r}::DOUBLE AS threshold,
  count_if(score > {t!r} AND quality = 1)::BIGINT AS tp,
  count_if(score > {t!r} AND quality <> 1)::BIGINT AS fp,
  count_if(NOT score > {t!r} AND quality <> 1)::BIGINT AS tn,
  count_if(NOT score > {t!r} AND quality = 1)::BIGINT AS fn
FROM sc""")
    return "\nUNION ALL\n".join(rows)


def _metric_cols_sql():
    return """round((tp + tn) / (tp + fp + tn + fn), 9) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall"""


def _round_metrics(df):
    return df.withColumns({c: F.round(c, 9) for c in ("accuracy", "precision", "recall")})


@query("threshold_metrics", "J3,J4,J5", f"""
WITH {_SCORE_SQL.strip()}, cm AS ({_sweep_sql([0.35])})
SELECT threshold, tp, fp, tn, fn, {_metric_cols_sql()} FROM cm
""")
def threshold_metrics(spark, d):
    """Accuracy, precision, recall at threshold 0.35 (positive iff score > t)."""
    return _round_metrics(metrics.threshold_metrics(_scored_docs(spark, d), "quality", "score", 0.35))


@query("threshold_sweep", "J6", f"""
WITH {_SCORE_SQL.strip()}, cm AS ({_sweep_sql([0.3, 0.52, 0.8])}),
mt AS (SELECT threshold, tp, fp, tn, fn, {_metric_cols_sql()}, (tp + tn) / (tp + fp + tn + fn) AS acc FROM cm)
SELECT threshold, tp, fp, tn, fn, accuracy, precision, recall,
       threshold = (SELECT threshold FROM mt ORDER BY acc DESC, threshold LIMIT 1) AS best
FROM mt
""")
def threshold_sweep(spark, d):
    """Metrics at 0.3, 0.52, 0.8 from one scan, with the most accurate flagged."""
    return _round_metrics(metrics.threshold_sweep(_scored_docs(spark, d), "quality", "score",
                                                  [0.3, 0.52, 0.8]))


def _auc_sql(n=100):
    ts = metrics.auc_thresholds(n)
    cols = ",\n".join(f"count_if(score > {t!r} AND quality = 1) AS tp_{i}, "
                      f"count_if(score > {t!r} AND quality <> 1) AS fp_{i}" for i, t in enumerate(ts))
    terms = " + ".join(
        f"((fp_{i} / neg) - (fp_{i + 1} / neg)) * ((tp_{i} / pos) + (tp_{i + 1} / pos)) / 2"
        for i in range(len(ts) - 1))
    return f"""
c AS (SELECT {cols}, count_if(quality = 1) AS pos, count_if(quality <> 1) AS neg FROM sc)
SELECT round({terms}, 9) AS auc, pos::BIGINT AS pos, neg::BIGINT AS neg FROM c"""


@query("auc_100", "J7", f"WITH {_SCORE_SQL.strip()},{_auc_sql(100)}")
def auc_100(spark, d):
    """ROC AUC over 100 thresholds by the trapezoid rule."""
    a = metrics.roc_auc(_scored_docs(spark, d), "quality", "score", 100)
    return a.withColumn("auc", F.round("auc", 9))
