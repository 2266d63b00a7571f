"""Queries for profiles, correlations, histograms and shape statistics (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.normal import inverse_normal_cdf_sql
from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators import ols, profile
from hearth.plans.common import (LINEITEM_MEASURES_SQL, MEASURE_COLS, lineitem_measures)
from hearth.plans.registry import query
from hearth.sources.tables import table

NUM4 = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _round_cols(df, cols, k):
    return df.withColumns({c: F.round(c, k) for c in cols})


def _describe_sql(cols, table_name="lineitem"):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  min({c})::DOUBLE AS min_raw, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
  quantile_cont({c}, 0.75) AS q75, max({c})::DOUBLE AS max_raw, count_if({c} IS NULL)::BIGINT AS na_count
  FROM {table_name}""")
    return "\nUNION ALL\n".join(parts)


@query("describe", "F1,F3,F5", f"""
SELECT "column", count, mean, std, round(min_raw, 6) AS min, round(q25, 6) AS q25,
       round(q50, 6) AS q50, round(q75, 6) AS q75, round(max_raw, 6) AS max
FROM ({_describe_sql(NUM4)})
""")
def describe(spark, d):
    """count, mean, std, min, quartiles (exact) and max per numeric column."""
    out = profile.describe(table(spark, d, "lineitem"), list(NUM4))
    return _round_cols(out, ["mean", "std", "min", "q25", "q50", "q75", "max"], 6)


@query("r_summary", "F2", f"""
SELECT "column", round(min_raw, 6) AS min, round(q25, 6) AS q1, round(q50, 6) AS median,
       mean, round(q75, 6) AS q3, round(max_raw, 6) AS max, na_count
FROM ({_describe_sql(NUM4)})
""")
def r_summary(spark, d):
    """min, quartiles, median, mean, max and NA count per column."""
    out = profile.r_summary(table(spark, d, "lineitem"), list(NUM4))
    return _round_cols(out, ["min", "q1", "median", "mean", "q3", "max"], 6)


@query("level_counts", "F2", """
SELECT p_type, count(*) AS n FROM part GROUP BY p_type
""")
def level_counts(spark, d):
    """Counts per level of a string column."""
    return profile.level_counts(table(spark, d, "part"), "p_type")


@query("global_minmax", "F4", """
SELECT 'l_quantity' AS "column", min(l_quantity) + 0.0 AS min, max(l_quantity) + 0.0 AS max FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice) + 0.0, max(l_extendedprice) + 0.0 FROM lineitem
UNION ALL SELECT 'l_discount', min(l_discount) + 0.0, max(l_discount) + 0.0 FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax) + 0.0, max(l_tax) + 0.0 FROM lineitem
""")
def global_minmax(spark, d):
    return profile.min_max(table(spark, d, "lineitem"), list(NUM4))


@query("column_moments", "F5", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 6) AS mean,
       round(stddev_samp(o_totalprice), 6) AS std, count(*) AS rows FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 6), round(stddev_samp(o_custkey), 6),
       count(*) FROM orders
""")
def column_moments(spark, d):
    out = profile.column_moments(table(spark, d, "orders"), ["o_totalprice", "o_custkey"])
    return _round_cols(out, ["mean", "std"], 6)


def _corr_sql():
    cols = MEASURE_COLS
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            rows.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round(corr({a}, {b}), 9) AS corr FROM measures")
            rows.append(f"SELECT '{b}', '{a}', round(corr({a}, {b}), 9) FROM measures")
        rows.append(f"SELECT '{a}', '{a}', 1.0::DOUBLE")
    return "\nUNION ALL\n".join(rows)


_CORR_SQL = f"WITH {LINEITEM_MEASURES_SQL.strip()},\ncm AS (\n{_corr_sql()})"


def _corr_long(spark, d):
    out = profile.correlation_matrix(lineitem_measures(spark, d), list(MEASURE_COLS))
    return out.withColumn("corr", F.round("corr", 9))


@query("corr_matrix", "F6", f"{_CORR_SQL}\nSELECT * FROM cm")
def corr_matrix(spark, d):
    """Pearson matrix of the lineitem measures, long form."""
    return _corr_long(spark, d)


def wide_columns(spark, d):
    """The embeddings as a wide table: the components and four functions of them
    (about 300 columns), with gaps where a component is close to zero."""
    e = table(spark, d, "embeddings").select("embedding")
    dims = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    cols = []
    for i in range(dims):
        v, w = (F.col("embedding")[k].cast("double") for k in (i, (i + 1) % dims))
        v = F.when(F.abs(v) >= 0.01, v)
        cols += [v.alias(f"x{i}"), (v * v).alias(f"s{i}"), F.abs(v).alias(f"a{i}"),
                 (v * w).alias(f"p{i}"), (v - w).alias(f"d{i}")]
    return e.select(*cols)


@query("corr_wide", "F6", """
WITH e AS (SELECT row_number() OVER () AS r, embedding AS x, len(embedding) AS n FROM embeddings),
v AS (SELECT r, k, CASE WHEN abs(x[k + 1]::DOUBLE) >= 0.01 THEN x[k + 1]::DOUBLE END AS v,
             x[(k + 1) % n + 1]::DOUBLE AS w
      FROM (SELECT *, unnest(range(n)) AS k FROM e)),
f AS (SELECT r, 'x' || k AS name, v FROM v UNION ALL SELECT r, 's' || k, v * v FROM v
      UNION ALL SELECT r, 'a' || k, abs(v) FROM v UNION ALL SELECT r, 'p' || k, v * w FROM v
      UNION ALL SELECT r, 'd' || k, v - w FROM v)
SELECT a.name AS feature_x, b.name AS feature_y,
       round(CASE WHEN a.name = b.name THEN 1.0 ELSE corr(a.v, b.v) END, 9) AS corr
FROM f a JOIN f b ON a.r = b.r GROUP BY a.name, b.name
""")
def corr_wide(spark, d):
    """Pearson matrix of some 300 columns with gaps, from one scan."""
    out = profile.correlation_matrix(wide_columns(spark, d))
    return out.withColumn("corr", F.round("corr", 9))


@query("corr_with_label", "F7,E14", f"""{_CORR_SQL}
SELECT feature_x AS feature, corr FROM cm WHERE feature_y = 'l_extendedprice' AND abs(corr) > 0.6
""")
def corr_with_label(spark, d):
    """Measures with |r| > 0.60 against the price (the price itself included)."""
    return profile.correlated_with(_corr_long(spark, d), "l_extendedprice", 0.6)


@query("collinear_pairs", "F8", f"""{_CORR_SQL},
lab AS (SELECT feature_x AS f, abs(corr) AS r FROM cm WHERE feature_y = 'l_extendedprice')
SELECT feature_x, feature_y, corr,
       CASE WHEN lx.r < ly.r THEN feature_x ELSE feature_y END AS drop_feature
FROM cm JOIN lab lx ON lx.f = feature_x JOIN lab ly ON ly.f = feature_y
WHERE feature_x < feature_y AND feature_x <> 'l_extendedprice'
  AND feature_y <> 'l_extendedprice' AND abs(corr) > 0.8
""")
def collinear_pairs(spark, d):
    """Feature pairs with |r| > 0.8 and the member to drop."""
    return profile.collinear_pairs(_corr_long(spark, d), "l_extendedprice", 0.8)


@query("independent_features", "F8", _CORR_SQL.replace("WITH", "WITH RECURSIVE", 1) + """,
ranked AS (SELECT feature_x AS f, abs(corr) AS r, row_number() OVER (ORDER BY abs(corr) DESC, feature_x) AS k
           FROM cm WHERE feature_y = 'l_extendedprice' AND feature_x <> 'l_extendedprice'),
near AS (SELECT feature_x AS f, list(feature_y) AS others FROM cm WHERE abs(corr) > 0.8 GROUP BY feature_x),
walk AS (SELECT 0::BIGINT AS k, NULL::VARCHAR AS f, NULL::DOUBLE AS r, NULL::VARCHAR AS because_of, []::VARCHAR[] AS kept
         UNION ALL
         SELECT k, f, r, because_of, CASE WHEN because_of IS NULL THEN list_append(kept, f) ELSE kept END
         FROM (SELECT ranked.k, ranked.f, ranked.r, w.kept,
                      list_filter(w.kept, lambda x: list_contains(others, x))[1] AS because_of
               FROM walk w JOIN ranked ON ranked.k = w.k + 1 JOIN near ON near.f = ranked.f))
SELECT f AS feature, r AS r_label, because_of IS NULL AS kept, because_of FROM walk WHERE k > 0
""")
def independent_features(spark, d):
    """The measures of which one of each collinear set is kept, best by |r| to the price first."""
    return profile.independent_features(_corr_long(spark, d), "l_extendedprice", 0.8)


def _hist_sql(col, tbl, n, alias="h"):
    return f"""
mm AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {tbl}),
cnt AS (SELECT least(greatest(floor(({col} - lo) / ((hi - lo) / {n}))::INTEGER, 0), {n - 1}) AS bin,
               count(*) AS count
        FROM {tbl}, mm WHERE {col} IS NOT NULL GROUP BY 1),
bins AS (SELECT range::INTEGER AS bin FROM range({n}))
SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / {n}), 6) AS lo,
       round(lo + (bins.bin + 1) * ((hi - lo) / {n}), 6) AS hi, coalesce(count, 0) AS count
FROM bins CROSS JOIN mm LEFT JOIN cnt ON cnt.bin = bins.bin"""


@query("histogram_30", "F9", "WITH " + _hist_sql("o_totalprice", "orders", 30).strip())
def histogram_30(spark, d):
    """30 equal-width bins of the order price, empty bins included."""
    h = profile.histogram(table(spark, d, "orders"), "o_totalprice", 30)
    return _round_cols(h, ["lo", "hi"], 6)


@query("hist_overlay", "F10,I18", """
WITH fit AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a,
                    regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem),
st AS (SELECT 'l_extendedprice' AS series, l_extendedprice AS value FROM lineitem
       UNION ALL SELECT 'predicted', a + b * l_quantity FROM lineitem, fit),
mm AS (SELECT min(value) AS lo, max(value) AS hi FROM st),
cnt AS (SELECT series, least(greatest(floor((value - lo) / ((hi - lo) / 30))::INTEGER, 0), 29) AS bin,
               count(*) AS count FROM st, mm GROUP BY 1, 2),
grid AS (SELECT s.series, range::INTEGER AS bin FROM range(30),
         (VALUES ('l_extendedprice'), ('predicted')) s(series))
SELECT grid.series, grid.bin, round(lo + grid.bin * ((hi - lo) / 30), 6) AS lo,
       round(lo + (grid.bin + 1) * ((hi - lo) / 30), 6) AS hi, coalesce(count, 0) AS count
FROM grid CROSS JOIN mm LEFT JOIN cnt ON cnt.series = grid.series AND cnt.bin = grid.bin
""")
def hist_overlay(spark, d):
    """Actual price vs the OLS prediction from quantity on shared bins."""
    l = table(spark, d, "lineitem")
    fit = ols.fit_simple_ols(l, "l_extendedprice", "l_quantity")
    scored = ols.predict(l, fit, "predicted")
    h = profile.histogram_overlay(scored, ["l_extendedprice", "predicted"], 30)
    return _round_cols(h, ["lo", "hi"], 6)


@query("hist2d", "F13", """
WITH mm AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1,
                   min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)
SELECT least(greatest(floor((l_quantity - x0) / ((x1 - x0) / 10))::INTEGER, 0), 9) AS bin_x,
       least(greatest(floor((l_extendedprice - y0) / ((y1 - y0) / 10))::INTEGER, 0), 9) AS bin_y,
       count(*) AS count
FROM lineitem, mm GROUP BY 1, 2
""")
def hist2d(spark, d):
    """10 x 10 bin counts of quantity vs price (the data behind a scatter)."""
    return profile.hist2d(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10, 10)


_PAIR_COLS = (*MEASURE_COLS, "l_linenumber")


def _pair_sql(bins: int = 8) -> str:
    ends = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(_PAIR_COLS))

    def b(i):
        return (f"least(greatest(floor(({_PAIR_COLS[i]} - lo{i}) / ((hi{i} - lo{i}) / {bins}))::INTEGER, 0), {bins - 1})")
    parts = [f"SELECT '{_PAIR_COLS[i]}' AS feature_x, '{_PAIR_COLS[j]}' AS feature_y, {b(i)} AS bin_x, {b(j)} AS bin_y, "
             f"count(*) AS count FROM measures, ends GROUP BY 3, 4"
             for i in range(len(_PAIR_COLS)) for j in range(i + 1, len(_PAIR_COLS))]
    return f"WITH {LINEITEM_MEASURES_SQL.strip()},\nends AS (SELECT {ends} FROM measures)\n" + "\nUNION ALL\n".join(parts)


@query("pair_plot", "F13", _pair_sql())
def pair_plot(spark, d):
    """8 x 8 bin counts of all 21 pairs of seven line-item measures, from one count."""
    return profile.pair_bins(lineitem_measures(spark, d), list(_PAIR_COLS), 8)


@query("sketch_quantiles", "F3,F1")
def sketch_quantiles_q(spark, d):
    """Approximate deciles of the measures from one scan of mergeable sketches."""
    return profile.sketch_quantiles(lineitem_measures(spark, d), list(MEASURE_COLS), [k / 10 for k in range(11)])


@query("scatter_sample", "F13", f"""
SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
WHERE {mix_unit_sql("l_orderkey", 111)} < 0.02
""")
def scatter_sample_q(spark, d):
    """A 2% seeded sample of (quantity, price) points, whole orders at a time."""
    l = table(spark, d, "lineitem")
    return profile.scatter_sample(l, "l_quantity", "l_extendedprice", "l_orderkey", 0.02, 111,
                                  draw=mix_unit("l_orderkey", 111))


def _box_sql(c):
    return f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round((SELECT min({c}) FROM lineitem WHERE {c} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round((SELECT max({c}) FROM lineitem WHERE {c} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
             quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""


@query("box_stats", "F12", "\nUNION ALL\n".join(_box_sql(c) for c in NUM4))
def box_stats(spark, d):
    """Quartiles, 1.5 IQR whiskers and outlier counts per column."""
    out = profile.box_stats(table(spark, d, "lineitem"), list(NUM4))
    return _round_cols(out, ["q1", "median", "q3", "whisker_lo", "whisker_hi"], 6)


@query("moments_shape", "F15", """
WITH m AS (SELECT avg(value) AS mu FROM events),
c AS (SELECT avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3,
             avg(power(value - mu, 4)) AS m4 FROM events, m)
SELECT 'value' AS "column", round(m3 / power(m2, 1.5), 6) AS skewness,
       round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM c
""")
def moments_shape(spark, d):
    """Population skewness and excess kurtosis of the event value."""
    out = profile.shape_moments(table(spark, d, "events"), ["value"])
    return _round_cols(out, ["skewness", "kurtosis"], 6)


@query("zero_share", "F20", """
SELECT 'l_discount' AS "column", count_if(l_discount = 0)::BIGINT AS zeros,
       round(count_if(l_discount = 0) / count(*), 9) AS share FROM lineitem
UNION ALL
SELECT 'l_tax', count_if(l_tax = 0)::BIGINT, round(count_if(l_tax = 0) / count(*), 9) FROM lineitem
""")
def zero_share(spark, d):
    out = profile.zero_share(table(spark, d, "lineitem"), ["l_discount", "l_tax"])
    return out.withColumn("share", F.round("share", 9))


_QQ_BASE = """
r AS (SELECT o_orderkey, o_totalprice AS value,
             row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rk,
             count(*) OVER () AS n FROM orders),
m AS (SELECT o_orderkey, rk, value,
             CASE WHEN rk = n THEN power(0.5, 1.0 / n)
                  WHEN rk = 1 THEN 1 - power(0.5, 1.0 / n)
                  ELSE (rk - 0.3175) / (n + 0.365) END AS p FROM r),
pts AS (SELECT o_orderkey, rk, value, """ + inverse_normal_cdf_sql("p") + """ AS osm FROM m)"""


@query("qq_normal", "F14", f"""
WITH {_QQ_BASE.strip()}
SELECT o_orderkey, rk::BIGINT AS rank, value, round(osm, 6) AS osm FROM pts
""")
def qq_normal(spark, d):
    """Ordered prices against Filliben normal order-statistic medians."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    pts, _ = profile.probplot(o, "o_totalprice", "o_orderkey")
    return pts.select("o_orderkey", "rank", "value", F.round("osm", 6).alias("osm"))


@query("qq_fit", "F14", f"""
WITH {_QQ_BASE.strip()}
SELECT round(regr_slope(value, osm), 4) AS slope, round(regr_intercept(value, osm), 4) AS intercept,
       round(corr(value, osm), 8) AS r FROM pts
""")
def qq_fit(spark, d):
    """Least-squares line through the probability plot and its r."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    _, fit = profile.probplot(o, "o_totalprice", "o_orderkey")
    return fit.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                      F.round("r", 8).alias("r"))


@query("kde_grid", "F11", """
WITH s AS (SELECT count(o_totalprice) AS n, stddev_samp(o_totalprice) * power(count(o_totalprice), -0.2) AS h,
                  min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
g AS (SELECT range AS point, (lo - 3 * h) + range * (((hi + 3 * h) - (lo - 3 * h)) / 99) AS x,
             h, n FROM range(100), s)
SELECT point::INTEGER AS point, round(x, 4) AS x,
       round(sum(exp(-0.5 * power((x - o_totalprice) / h, 2))) / (n * h * sqrt(2 * pi())) * 1e6, 6) AS density_e6
FROM g, orders GROUP BY point, x, n, h
""")
def kde_grid(spark, d):
    """Gaussian KDE (Scott bandwidth) of the order price on 100 points;
    density reported per million for a stable comparison."""
    k = profile.kde_grid(table(spark, d, "orders"), "o_totalprice", 100)
    return k.select(F.col("point").cast("int").alias("point"), F.round("x", 4).alias("x"),
                    F.round(F.col("density") * 1e6, 6).alias("density_e6"))
