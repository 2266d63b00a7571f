"""Column profiles and distribution statistics.

Moments, extremes, correlations and conditional counts are fused into one
aggregate per call (partial aggregation on every partition, one tiny final
merge). Exact quantiles use the distributed routine in ``ranking``.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from hearth.functions.normal import inverse_normal_cdf
from hearth.operators.comoments import co_moments
from hearth.operators.density import gauss_sums
from hearth.operators.ranking import column_quantiles, global_rank


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _one_row(df: DataFrame, exprs: list[Column]):
    return df.agg(*exprs).first()


def _profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max and null count per column:
    one aggregate plus the exact quartiles (long form)."""
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    qarr = F.create_map(*[x for c in cols for x in (
        F.lit(c), F.array(*[F.lit(v).cast("double") for v in q[c]]))])
    stats = df.agg(*[F.struct(F.lit(c).alias("column"),
                              F.count(c).alias("count"),
                              F.avg(c).cast("double").alias("mean"),
                              F.stddev_samp(c).alias("std"),
                              F.min(c).cast("double").alias("min"),
                              F.max(c).cast("double").alias("max"),
                              F.count_if(F.col(c).isNull()).alias("na_count")).alias(f"s{i}")
                     for i, c in enumerate(cols)])
    long = stats.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s"))
    quart = F.element_at(qarr, F.col("s.column"))
    return long.select("s.column", "s.count", "s.mean", "s.std", "s.min",
                       quart[0].alias("q25"), quart[1].alias("q50"), quart[2].alias("q75"),
                       "s.max", "s.na_count")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, q25, q50, q75, max per column (F1).

    Quantiles are exact (linear interpolation), unlike ``DataFrame.summary``.
    """
    cols = list(cols or _numeric_cols(df))
    return _profile(df, cols).drop("na_count")


def r_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """R ``summary``: min, 1st quartile, median, mean, 3rd quartile, max and
    NA count per numeric column (F2), from the same single aggregate."""
    cols = list(cols or _numeric_cols(df))
    return _profile(df, cols).select(
        "column", "min", F.col("q25").alias("q1"), F.col("q50").alias("median"), "mean",
        F.col("q75").alias("q3"), "max", "na_count")


def level_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per level of a string column (F2, factor part)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Global min and max per column in one aggregate (F4), long form."""
    # "+ 0.0" folds a negative zero into 0.0 so equal extremes print alike.
    row = df.agg(*[F.struct(F.lit(c).alias("column"), (F.min(c).cast("double") + 0.0).alias("min"),
                            (F.max(c).cast("double") + 0.0).alias("max")).alias(f"s{i}")
                   for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")) \
              .select("s.*")


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: non-null count, mean, sample std, row count."""
    row = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                            F.avg(c).cast("double").alias("mean"),
                            F.stddev_samp(c).alias("std"),
                            F.count(F.lit(1)).alias("rows")).alias(f"s{i}")
                   for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")) \
              .select("s.*")


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, *,
                       max_pairs_per_pass: int = 300) -> DataFrame:
    """Pearson correlation of every pair, long form (feature_x, feature_y, corr).

    Rows where either value is null are skipped (pairwise deletion, as pandas
    does); the matrix is symmetric, with 1.0 on the diagonal. Up to
    ``max_pairs_per_pass`` pairs are one aggregate with the three centred sums of
    each (Spark's own ``corr`` fails on a constant column in ANSI mode); wider tables go through :func:`comoments.co_moments`, one scan as well. A
    pair with fewer than two rows or a constant side has no correlation.
    """
    cols = list(cols or _numeric_cols(df))
    if not cols:
        return df.sparkSession.createDataFrame([], "feature_x string, feature_y string, corr double")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if len(pairs) > max_pairs_per_pass:
        return _wide_correlation(df, cols)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b))).alias(f"c{k}")
                   for k, (a, b) in enumerate(pairs)])
    entries = [F.struct(F.lit(c).alias("feature_x"), F.lit(c).alias("feature_y"), F.lit(1.0).alias("corr"))
               for c in cols]
    for k, (a, b) in enumerate(pairs):
        entries += [F.struct(F.lit(x).alias("feature_x"), F.lit(y).alias("feature_y"), F.col(f"c{k}").alias("corr"))
                    for x, y in ((a, b), (b, a))]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _wide_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    moments = co_moments(df, cols)
    names = F.array(*map(F.lit, cols))
    r = F.when((F.col("n") > 1) & (F.col("c_xx") > 0) & (F.col("c_yy") > 0),
               F.col("c_xy") / F.sqrt(F.col("c_xx") * F.col("c_yy")))
    half = moments.select(names[F.col("x")].alias("a"), names[F.col("y")].alias("b"),
                          F.when(F.col("x") == F.col("y"), 1.0).otherwise(r).alias("corr"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return half.select(F.explode(both).alias("p"), "corr").select(
        F.col("p.a").alias("feature_x"), F.col("p.b").alias("feature_y"), "corr")


def correlated_with(corr: DataFrame, label: str, cut: float = 0.60) -> DataFrame:
    """Features whose |r| with ``label`` exceeds ``cut`` (F7); the label
    itself qualifies (r = 1), as in R's ``cor`` row selection."""
    return (corr.filter((F.col("feature_y") == label) & (F.abs("corr") > cut))
                .select(F.col("feature_x").alias("feature"), "corr"))


def collinear_pairs(corr: DataFrame, label: str, cut: float = 0.8) -> DataFrame:
    """Feature pairs with |r| > cut, each once, with the one to drop (F8):
    the member with the lower |r| to the label (ties: the later name)."""
    to_label = corr.filter(F.col("feature_y") == label).select(
        F.col("feature_x").alias("f"), F.abs("corr").alias("r_label"))
    pairs = corr.filter((F.col("feature_x") < F.col("feature_y"))
                        & (F.col("feature_x") != label) & (F.col("feature_y") != label)
                        & (F.abs("corr") > cut))
    rx = to_label.select(F.col("f").alias("feature_x"), F.col("r_label").alias("rx"))
    ry = to_label.select(F.col("f").alias("feature_y"), F.col("r_label").alias("ry"))
    out = pairs.join(rx, "feature_x", "left").join(ry, "feature_y", "left")
    return out.select("feature_x", "feature_y", "corr",
                      F.when(F.col("rx") < F.col("ry"), F.col("feature_x"))
                       .otherwise(F.col("feature_y")).alias("drop_feature"))


def independent_features(corr: DataFrame, label: str, cut: float = 0.8) -> DataFrame:
    """Keep one of each set of collinear features (F8): (feature, r_label, kept,
    because_of), the label left aside.

    Features are taken by falling |r| to the label (none last, ties by name),
    and one is kept if its |r| with every kept one is at most ``cut``;
    ``because_of`` is the first kept feature that rules it out. Of a chain a-b-c,
    in which dropping the worse end of each pair can remove both a and c's only
    neighbours, this leaves a largest set by that order. The pairs over the cut,
    at most (number of columns)^2, are gathered.
    """
    spark = corr.sparkSession
    order = (corr.filter((F.col("feature_y") == label) & (F.col("feature_x") != label))
             .select(F.col("feature_x").alias("f"), F.abs("corr").alias("r")).collect())
    order = sorted(order, key=lambda x: (x["r"] is None, -(x["r"] or 0.0), x["f"]))
    near: dict[str, set[str]] = {}
    for x in corr.filter(F.abs("corr") > cut).select("feature_x", "feature_y").collect():
        near.setdefault(x[0], set()).add(x[1])
    kept, rows = [], []
    for x in order:
        ruled = next((k for k in kept if k in near.get(x["f"], ())), None)
        if ruled is None:
            kept.append(x["f"])
        rows.append((x["f"], x["r"], ruled is None, ruled))
    return spark.createDataFrame(rows, "feature string, r_label double, kept boolean, because_of string")


def _bin_expr(x: Column, lo: float, hi: float, n: int) -> Column:
    if hi <= lo:
        return F.when(x.isNotNull(), F.lit(0))
    b = F.floor((x - F.lit(lo)) / F.lit((hi - lo) / n)).cast("int")
    return F.least(F.greatest(b, F.lit(0)), F.lit(n - 1))


def histogram(df: DataFrame, col: str, n_bins: int = 30, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width histogram on [min, max] (F9): (bin, lo, hi, count).

    The maximum goes into the last bin. Counting is one grouped aggregate
    over at most ``n_bins`` keys; empty bins are filled from a generated
    range of ``n_bins`` rows.
    """
    if lo is None or hi is None:
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    spark = df.sparkSession
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return bins.select("bin", F.lit(None).cast("double").alias("lo"),
                           F.lit(None).cast("double").alias("hi"), F.lit(0).cast("long").alias("count"))
    width = (hi - lo) / n_bins
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(_bin_expr(F.col(col), lo, hi, n_bins).alias("bin"))
                .agg(F.count(F.lit(1)).alias("count")))
    return (bins.join(counts, "bin", "left")
                .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def histogram_overlay(df: DataFrame, cols: Sequence[str], n_bins: int = 30) -> DataFrame:
    """Several series on shared bins, e.g. actual vs predicted (F10):
    (series, bin, lo, hi, count)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("s")).select("s.*")
    r = stacked.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:      # no value at all: no range, no bins
        return df.sparkSession.createDataFrame([], "series string, bin int, lo double, hi double, count long")
    width = (hi - lo) / n_bins
    counts = (stacked.where(F.col("value").isNotNull())
                     .groupBy("series", _bin_expr(F.col("value"), lo, hi, n_bins).alias("bin"))
                     .agg(F.count(F.lit(1)).alias("count")))
    grid = (df.sparkSession.range(n_bins)
              .select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("series"),
                      F.col("id").cast("int").alias("bin")))
    return (grid.join(counts, ["series", "bin"], "left")
                .select("series", "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def hist2d(df: DataFrame, x: str, y: str, nx: int = 30, ny: int = 30) -> DataFrame:
    """2-D bin counts standing in for a scatter plot (F13): non-empty
    (bin_x, bin_y, count) cells only."""
    r = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"),
               F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if r["x0"] is None or r["y0"] is None:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, count long")
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
              .groupBy(_bin_expr(F.col(x), r["x0"], r["x1"], nx).alias("bin_x"),
                       _bin_expr(F.col(y), r["y0"], r["y1"], ny).alias("bin_y"))
              .agg(F.count(F.lit(1)).alias("count")))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """2-D bin counts of every pair of columns, the data of a pair plot (F13):
    (feature_x, feature_y, bin_x, bin_y, count), non-empty cells only, each
    unordered pair once in the order of ``cols``.

    Two scans for any number of pairs: the extremes, then one count in which a
    row's bins, found once, go into the cells of all its pairs and are combined
    before the shuffle (at most pairs x ``bins``^2 rows leave a task). A row
    counts in the pairs whose two values are there.
    """
    cols = list(cols)
    ends = df.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(cols)
                    for n, f in (("lo", F.min), ("hi", F.max))]).first()
    binned = [F.when(F.col(c).isNotNull(), _bin_expr(F.col(c), ends[f"lo{i}"], ends[f"hi{i}"], bins))
              if ends[f"lo{i}"] is not None else F.lit(None) for i, c in enumerate(cols)]
    rows = df.select(F.array(*[b.cast("int") for b in binned]).alias("b"))
    pairs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("b")[i].alias("bin_x"), F.col("b")[j].alias("bin_y"))
             for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_x string, feature_y string, bin_x int, bin_y int, count long")
    names = F.array(*map(F.lit, cols))
    cells = rows.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("bin_x IS NOT NULL AND bin_y IS NOT NULL")
    counted = cells.groupBy("i", "j", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(names[F.col("i")].alias("feature_x"), names[F.col("j")].alias("feature_y"),
                          "bin_x", "bin_y", "count")


def sketch_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], k: int = 400) -> DataFrame:
    """Approximate quantiles of several columns from one scan (F3): (column,
    prob, value, rank_error).

    Each column has a mergeable KLL sketch of parameter ``k``; it stays at some
    kilobytes for any number of rows. ``rank_error`` is the sketch's normalised
    rank error at 99 % confidence for one quantile, 2.296 / k^0.9021: the value's
    rank, divided by the number of values, is that close to ``prob``. Nulls
    and NaNs are left out; a column without values has null quantiles.
    """
    probs = [float(p) for p in probs]
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    one = df.agg(*[F.kll_sketch_agg_double(v, F.lit(k)).alias(f"s{i}") for i, v in enumerate(values)],
                 *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)])
    entries = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"),
                        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), F.lit(p))).alias("value"))
               for i, c in enumerate(cols) for p in probs]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*", F.lit(2.296 / k ** 0.9021).alias("rank_error"))


def scatter_sample(df: DataFrame, x: str, y: str, key: str, fraction: float, seed: int,
                   *, draw: Column | None = None) -> DataFrame:
    """Seeded sample of (x, y) points for a scatter plot.

    Rows whose hashed draw of ``key`` falls below ``fraction`` are kept:
    the same rows for any partitioning or task retry. The sample is the
    feature here; counts over all rows are in :func:`hist2d`.
    """
    from hearth.functions.scalar import unit_hash
    u = draw if draw is not None else unit_hash(key, seed)
    return df.where(u < F.lit(float(fraction))).select(key, x, y)


def box_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Box-plot statistics per column (F12): q1, median, q3, whiskers at the
    most extreme values within 1.5 IQR of the box, outlier count."""
    q = column_quantiles(df, list(cols), [0.25, 0.5, 0.75])
    parts = []
    for i, c in enumerate(cols):
        q1, med, q3 = q[c]
        if q1 is None:
            continue
        iqr = q3 - q1
        lo_f, hi_f = q1 - 1.5 * iqr, q3 + 1.5 * iqr
        x = F.col(c)
        parts.append(F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(med).alias("median"),
            F.lit(q3).alias("q3"),
            F.min(F.when(x >= lo_f, x)).cast("double").alias("whisker_lo"),
            F.max(F.when(x <= hi_f, x)).cast("double").alias("whisker_hi"),
            F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers")).alias(f"s{i}"))
    one = df.agg(*parts)
    return one.select(F.explode(F.array(*[F.col(p) for p in one.columns])).alias("s")).select("s.*")


def shape_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Skewness and excess kurtosis (population moments) per column."""
    one = df.agg(*[F.struct(F.lit(c).alias("column"), F.skewness(c).alias("skewness"),
                            F.kurtosis(c).alias("kurtosis")).alias(f"s{i}")
                   for i, c in enumerate(cols)])
    return one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")) \
              .select("s.*")


def zero_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of exact zeros per column."""
    one = df.agg(*[F.struct(F.lit(c).alias("column"),
                            F.count_if(F.col(c) == 0).alias("zeros"),
                            F.count(F.lit(1)).alias("rows")).alias(f"s{i}")
                   for i, c in enumerate(cols)])
    return (one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s"))
               .select("s.column", "s.zeros", (F.col("s.zeros") / F.col("s.rows")).alias("share")))


def kde_grid(df: DataFrame, col: str, n_points: int = 100, bandwidth: float | None = None,
             cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid (F11): (point, x, density).

    Bandwidth defaults to Scott's rule (n^-1/5 times the sample std). The
    grid spans min - cut*h to max + cut*h. Two scans: the range, then a fast
    Gauss transform (``density.gauss_sums``: 18 products a row instead of an
    exponential for every grid point). A density is off by at most 1e-13 of the
    highest that n rows can give, 1 / (h sqrt(2 pi)). Without values or spread
    (and no bandwidth given) all densities are null.
    """
    r = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"),
               F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n = r["n"]
    h = bandwidth or ((r["sd"] or 0.0) * n ** (-1.0 / 5.0) if n else 0.0)
    if not n or not h or h <= 0:    # no value, or no spread to choose a bandwidth by
        return df.sparkSession.createDataFrame(
            [(k, None if r["lo"] is None else float(r["lo"]), None) for k in range(n_points)],
            "point int, x double, density double")
    lo, hi = float(r["lo"]) - cut * h, float(r["hi"]) + cut * h
    step = (hi - lo) / (n_points - 1)
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    return gauss_sums(df, col, lo, step, n_points, h).select(
        "point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"), (F.col("total") * F.lit(norm)).alias("density"))


def probplot(df: DataFrame, col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Normal probability plot.

    Returns (points, fit): points are (id, rank, value, osm) with Filliben's
    order-statistic medians m_i = (i - 0.3175)/(n + 0.365), ends 1 - 0.5^(1/n)
    and 0.5^(1/n), mapped through the inverse normal CDF; fit is the least
    squares line of value on osm with its correlation r. Ranks come from the
    range-partitioned global rank (ties broken by ``id_col``).
    """
    base = df.where(F.col(col).isNotNull()).select(id_col, F.col(col).cast("double").alias("value"))
    ranked, n = global_rank(base, ["value", id_col], rank_col="rank")
    i = F.col("rank").cast("double")
    last = 0.5 ** (1.0 / n) if n else None
    m = (F.when(F.col("rank") == n, F.lit(last))
          .when(F.col("rank") == 1, F.lit(1.0 - last if n else None))
          .otherwise((i - 0.3175) / F.lit(n + 0.365)))
    points = ranked.select(id_col, "rank", "value", inverse_normal_cdf(m).alias("osm"))
    fit = points.agg(F.regr_slope("value", "osm").alias("slope"),
                     F.regr_intercept("value", "osm").alias("intercept"),
                     F.corr("value", "osm").alias("r"))
    return points, fit
