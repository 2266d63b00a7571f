"""Unit and property tests on small hand-made frames."""

import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from hearth.functions import distributions as D
from hearth.functions.normal import inverse_normal_cdf
from hearth.operators import clean, columns, features, metrics, ols, profile, ranking, sampling
from hearth.sources.csv import read_csv


def test_regular_boundaries_truncate_toward_zero(spark):
    df = spark.createDataFrame([(-124.35,), (-114.31,)], "x double")
    b = features.regular_boundaries(df, "x", 1.0)
    assert b[0] == -124 and b[-1] == -115 and len(b) == 10


def test_bucket_left_closed(spark):
    df = spark.createDataFrame([(-1.5,), (0.0,), (0.5,), (1.0,), (2.0,), (9.9,), (None,)], "x double")
    got = [r[0] for r in df.select(features.bucket_index("x", [1.0, 2.0])).collect()]
    assert got == [0, 0, 0, 1, 2, 2, None]


def test_na_modes(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as f:
        f.write("Id,LotFrontage,Electrical\n1,80,SBrkr\n2,NA,NA\n3,70,FuseA\n")
    lit = read_csv(spark, path, na_mode="literal")
    nul = read_csv(spark, path, na_mode="null")
    assert dict(lit.dtypes)["LotFrontage"] == "string"
    assert dict(nul.dtypes)["LotFrontage"] == "int"
    # the marker filter keeps the same rows in both modes
    a = sorted(r.Id for r in clean.drop_missing_marker(lit, "Electrical").collect())
    b = sorted(r.Id for r in clean.drop_missing_marker(nul, "Electrical").collect())
    assert a == b == [1, 3]
    # a numeric column read in null mode: the marker rule drops the nulls
    c = sorted(r.Id for r in clean.drop_missing_marker(nul, "LotFrontage").collect())
    assert c == [1, 3]


def test_missing_report_and_groups(spark):
    df = spark.createDataFrame([(1, None, None, 1.0), (2, "a", None, float("nan")),
                                (3, None, 5, 2.0), (4, "b", None, 3.0)],
                               "id int, s string, k int, x double")
    rep = {r.feature: (r.total, r.percent) for r in clean.missing_report(df).collect()}
    assert rep == {"k": (3, 75.0), "s": (2, 50.0), "x": (1, 25.0)}
    assert clean.sparse_columns(df, 60.0) == ["k"]
    groups = clean.missing_groups(clean.missing_report(df, nonzero_only=False)).collect()
    assert {g.total: g.features for g in groups}[0] == "id"


def test_exclude_ids_list_and_frame(spark):
    df = spark.range(10).withColumnRenamed("id", "Id")
    assert clean.exclude_ids(df, "Id", [3, 4]).count() == 8
    ids = spark.createDataFrame([(1,), (2,), (2,)], "Id long")
    assert clean.exclude_ids(df, "Id", ids).count() == 8


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id int, c string")
    out = clean.one_hot_columns(df, "c")
    assert out.columns == ["id", "a", "b", "c"]
    assert all(r.a + r.b + r.c == 1 for r in out.collect())
    with pytest.raises(ValueError):
        clean.one_hot_columns(df, "c", max_levels=2)


def test_impute_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 10.0)], "id int, x double")
    got = {r.id: r.x for r in clean.impute_median(df, ["x"]).collect()}
    assert got[2] == 3.0


def test_exact_quantiles_skewed(spark):
    # a third of all rows hold one value
    rows = [(float(i % 97),) for i in range(2000)] + [(42.0,)] * 1000
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = df.select(F.percentile("x", probs)).first()[0]
    assert ranking.exact_quantiles(df, "x", probs) == pytest.approx(want)
    # tiny buckets and fetch limit force several narrowing passes
    assert ranking.exact_quantiles(df, "x", probs, bins=4, max_fetch=10) == pytest.approx(want)


def test_exact_quantiles_many_passes_continuous(spark):
    df = spark.range(5000).select((F.exp(F.col("id") / 500.0) + F.sin("id")).alias("x"),
                                  (F.col("id") % 7).cast("double").alias("y"))
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = ranking.column_quantiles(df, ["x", "y"], probs, bins=8, max_fetch=20)
    want = df.select(F.percentile("x", probs), F.percentile("y", probs)).first()
    assert got["x"] == pytest.approx(want[0]) and got["y"] == pytest.approx(want[1])


def test_quantiles_empty_and_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert ranking.exact_quantiles(df, "x", [0.5]) == [None]


def test_global_rank_matches_row_number_on_skew(spark):
    rows = [(i, 5.0 if i % 3 == 0 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double")
    ranked, n = ranking.global_rank(df, ["v", "id"], num_partitions=5)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    j = ranked.join(ref, ["id", "v"])
    assert n == 3000 and j.filter("rank != rn").count() == 0


def test_zscore_properties(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "x double")
    z = features.zscore(df, ["x"], ddof=1)
    r = z.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).first()
    assert abs(r.m) < 1e-12 and abs(r.s - 1) < 1e-12
    zp = features.zscore(df, ["x"], ddof=0)
    assert abs(zp.agg(F.stddev_pop("x")).first()[0] - 1) < 1e-12


def test_string_indexer_ties_and_unseen(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "c string")
    out, model = features.string_index(tr, ["c"])
    codes = {r.c: r.c_Index for r in model.transform(tr).select("c", "c_Index").distinct().collect()}
    assert codes == {"a": 0.0, "b": 1.0, "c": 2.0}
    te = spark.createDataFrame([("z",), ("a",)], "c string")
    assert sorted(r.c_Index for r in model.transform(te).collect()) == [0.0, 3.0]


def test_histogram_counts_sum(spark):
    df = spark.range(1000).select((F.col("id") * 0.37).alias("x"))
    h = profile.histogram(df, "x", 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == 1000


def test_corr_matrix_symmetric(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"),
                                 (F.col("id") * 2 + F.sin("id")).alias("b"),
                                 F.cos("id").alias("c"))
    m = {(r.feature_x, r.feature_y): r.corr for r in profile.correlation_matrix(df).collect()}
    assert m[("a", "a")] == 1.0 and m[("a", "b")] == m[("b", "a")]


def test_ols_exact_line_and_inference(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    fit = ols.fit_simple_ols(df, "y", "x")
    assert fit.slope == pytest.approx(2.0) and fit.intercept == pytest.approx(1.0)
    assert fit.rss == pytest.approx(0.0, abs=1e-9)
    two = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0)], "x double, y double")
    f2 = ols.fit_simple_ols(two, "y", "x")
    assert f2.df_resid == 0 and math.isnan(f2.sigma2)


def test_ols_residuals_orthogonal(spark):
    df = spark.range(500).select(F.col("id").cast("double").alias("x"),
                                 (F.col("id") * 0.5 + F.sin("id") * 3).alias("y"))
    fit = ols.fit_simple_ols(df, "y", "x")
    r = ols.predict(df, fit).select((F.col("y") - F.col("prediction")).alias("e"), "x")
    s = r.agg(F.sum("e"), F.sum(F.col("e") * F.col("x"))).first()
    assert abs(s[0]) < 1e-6 and abs(s[1]) < 1e-3


def test_t_distribution_values():
    assert D.t_quantile(0.975, 10) == pytest.approx(2.228138852, abs=1e-8)
    assert D.t_two_sided_p(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert D.f_sf(4.964602743, 1, 10) == pytest.approx(0.05, abs=1e-7)


def test_t_tail_of_many_degrees_of_freedom():
    import math
    import numpy as np
    for df in (1000, 59998, 10 ** 7):
        for t in (0.84, 1.96, 5.0):
            # t = sqrt(df) tan(u); Simpson's rule over the tail and the half line
            u0, u1 = math.atan(t / math.sqrt(df)), min(math.pi / 2, 60 / math.sqrt(df))

            def area(a, b, n=400_000):
                i = np.arange(n + 1)
                w = np.where(i % n == 0, 1, np.where(i % 2 == 1, 4, 2))
                u = a + (b - a) * i / n
                with np.errstate(divide="ignore"):
                    return float(np.sum(w * np.exp((df - 1) * 0.5 * np.log1p(-np.sin(u) ** 2)))) * (b - a) / n
            assert D.t_two_sided_p(t, df) == pytest.approx(area(u0, u1) / area(0.0, u1), rel=1e-9)
    # at a trillion rows the t tail is the normal tail
    assert D.t_two_sided_p(1.96, 1e12) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-11)
    assert D.t_quantile(0.975, 1e12) == pytest.approx(1.959963984540054, abs=1e-10)


def test_inverse_normal(spark):
    df = spark.createDataFrame([(0.5,), (0.975,), (0.01,), (0.0,)], "p double")
    got = [r[0] for r in df.select(inverse_normal_cdf("p")).collect()]
    assert got[0] == pytest.approx(0.0, abs=1e-9)
    assert got[1] == pytest.approx(1.959963985, abs=1e-7)
    assert got[2] == pytest.approx(-2.326347874, abs=1e-7)
    assert got[3] is None


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_exact_sample_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = sampling.exact_sample(df, 0.75, "k", 111)
    rows = out.collect()
    assert len(rows) == n
    assert sum(r.in_sample for r in rows) == int(0.75 * n)


def test_weighted_split_normalised(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a, b = sampling.weighted_split(df, [0.9, 0.2], "k", 3)
    na, nb = a.count(), b.count()
    assert na + nb == 20000 and abs(na / 20000 - 0.9 / 1.1) < 0.02
    assert a.join(b, "k").count() == 0


def test_threshold_metrics_strict_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    r = metrics.threshold_metrics(df, "y", "s", 0.5).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (1, 0, 2, 1)
    one = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, s double")
    r1 = metrics.threshold_metrics(one, "y", "s", 0.5).first()
    assert r1.precision == 0.0 and r1.recall == 0.0


def test_auc_bounds_and_monotone_invariance(spark):
    rows = [(1 if i % 3 else 0, ((i * 37) % 100) / 100.0) for i in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = metrics.roc_auc(df, "y", "s").first().auc
    perfect = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.8), (0, 0.2)], "y int, s double")
    assert 0.0 <= a <= 1.0
    assert metrics.roc_auc(perfect, "y", "s").first().auc == pytest.approx(1.0)


def test_probplot_filliben_ends(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "id int, x double")
    pts, fit = profile.probplot(df, "x", "id")
    r = pts.orderBy("rank").collect()
    assert r[0].osm == pytest.approx(-r[-1].osm, abs=1e-9)
    assert 0.97 < fit.first().r < 0.99  # uniform data bend away from the normal line


def test_box_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    b = profile.box_stats(df, ["x"]).first()
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)
    assert b.whisker_hi == 8.0 and b.n_outliers == 1


def test_schema_profile(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    rows = columns.schema_profile(df).collect()
    assert [(r.column, r.type, r.position, r.row_count) for r in rows] == \
        [("a", "int", 1, 1), ("b", "string", 2, 1)]


def test_string_index_na_modes_agree(spark):
    lit = spark.createDataFrame([("a",), ("NA",), ("a",), ("b",)], "c string")
    nul = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "c string")
    a, _ = features.string_index(lit, ["c"], na_as_level=True)
    b, _ = features.string_index(nul, ["c"], na_as_level=True)
    assert sorted(r.c_Index for r in a.collect()) == sorted(r.c_Index for r in b.collect())


def test_auc_binned_close_to_exact(spark):
    rows = [(1 if (i * 7919) % 10 < 6 + (i % 3) else 0, ((i * 37) % 1000) / 1000.0)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "y int, s double")
    binned = metrics.roc_auc(df, "y", "s", 100).first().auc
    assert abs(binned - metrics.roc_auc_exact(df, "y", "s")) < 0.01


def test_ols_tables_are_spark_derived_and_consistent(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"),
                                (F.col("id") * 1.5 + F.sin("id") * 4).alias("y"))
    tab = {r.term: r for r in ols.coefficient_table(df, "y", "x").collect()}
    fit = ols.fit_simple_ols(df, "y", "x")
    assert tab["x"].estimate == pytest.approx(fit.slope)
    assert tab["x"].std_error == pytest.approx(fit.se_slope())
    assert tab["x"].p_value == pytest.approx(D.t_two_sided_p(fit.slope / fit.se_slope(), 48))
    ci = {r.term: r for r in ols.confint(df, "y", "x").collect()}
    tq = D.t_quantile(0.975, 48)
    assert ci["x"].lower == pytest.approx(fit.slope - tq * fit.se_slope())
    st = ols.fit_statistics(df, fit).first()
    assert st.r_squared == pytest.approx(fit.r2()) and 0 <= st.f_p_value <= 1


def test_quantiles_extreme_range(spark):
    xs = [-1.7e308, -1.0, 0.0, 2.5, 1.7e308] * 30
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = ranking.exact_quantiles(df, "x", [0.1, 0.5, 0.9], bins=4, max_fetch=10)
    import numpy as np
    assert got == pytest.approx(list(np.quantile(np.array(xs), [0.1, 0.5, 0.9])))


def test_hashed_cross_matches_brute_force(spark):
    pairs = [(a, b) for a in range(0, 300, 7) for b in range(0, 9)] + [(None, 1), (2, None)]
    df = spark.createDataFrame(pairs, "b1 int, b2 int")
    got = {(r.b1, r.b2): r.h for r in df.select("b1", "b2",
           features.hashed_cross("b1", "b2", 100).alias("h")).collect()}
    import duckdb
    con = duckdb.connect()
    for (a, b), h in got.items():
        if a is None or b is None:
            assert h is None
        else:
            assert h == con.execute("SELECT " + features.hashed_cross_sql(str(a), str(b), 100)).fetchone()[0]
    assert len({h for h in got.values() if h is not None}) > 90      # the bins are used evenly


def test_level_codes_match_the_indexer_and_keep_nulls(spark):
    vals = ["b", "a", "c", "b", "a", "d", None, "c", "c", None]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, c string")
    got = {r.id: r.c_Index for r in
           features.apply_level_codes(df, features.level_codes(df, "c"), "c").collect()}
    want = {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0, None: None}
    assert got == {i: want[v] for i, v in enumerate(vals)}
    model = features.string_indexer(["c"]).fit(df)
    assert list(model.labelsArray[0]) == ["c", "a", "b", "d"]
    empty = df.limit(0)
    assert features.level_codes(empty, "c").count() == 0


def test_one_hot_long_has_no_level_bound(spark):
    df = spark.range(2500).selectExpr("id", "concat('v', id) AS c")
    rows = features.one_hot_long(df, ["id"], "c").collect()
    assert len(rows) == 2500 and {r.code for r in rows} == set(range(2500))


def test_cell_mean_errors_match_numpy_with_unseen_cells(spark):
    from hearth.operators import models
    rows = [(k, i % 5 if i % 4 else 7 + i % 3, float((i * 37) % 11), i % 4 != 0)
            for k in ("a", "b") for i in range(60)] + [("a", 1, None, True)]
    df = spark.createDataFrame(rows, "k string, cell int, y double, tr boolean")
    got = {r.k: r for r in models.cell_mean_errors(df, ["k"], "cell", "y", F.col("tr")).collect()}
    for key in ("a", "b"):
        mine = [r for r in rows if r[0] == key and r[2] is not None]
        train = [r for r in mine if r[3]]
        base = sum(r[2] for r in train) / len(train)
        means = {c: sum(r[2] for r in train if r[1] == c) / sum(r[1] == c for r in train)
                 for c in {r[1] for r in train}}
        for side, name in ((True, "train_rmse"), (False, "test_rmse")):
            err = [(r[2] - means.get(r[1], base)) ** 2 for r in mine if r[3] == side]
            assert got[key][name] == pytest.approx((sum(err) / len(err)) ** 0.5, rel=1e-12)
    only_train = models.cell_mean_errors(df.where("tr"), ["k"], "cell", "y", F.col("tr")).collect()
    assert all(r.test_rmse is None and r.train_rmse is not None for r in only_train)


def test_unit_hash_matches_brute_force(spark):
    import struct
    import xxhash
    from hearth.functions.scalar import unit_hash

    def chain(parts):
        h = 42
        for fmt, v in parts:
            h = xxhash.xxh64(struct.pack(fmt, v), seed=h & 0xFFFFFFFFFFFFFFFF).intdigest()
            h = h - (1 << 64) if h >= (1 << 63) else h
        return h

    df = spark.range(200).withColumnRenamed("id", "k")
    got = {r.k: r.u for r in df.select("k", unit_hash("k", 7).alias("u")).collect()}
    want = {k: (chain([("<q", k), ("<i", 7)]) % (1 << 30)) / float(1 << 30) for k in range(200)}
    assert got == want


def test_corr_matrix_chunked_equals_single_pass(spark):
    df = spark.range(300).select(*[(F.sin(F.col("id") * (k + 1)) + F.col("id") * k).alias(f"x{k}")
                                   for k in range(7)])
    one = {(r.feature_x, r.feature_y): r.corr for r in profile.correlation_matrix(df).collect()}
    many = {(r.feature_x, r.feature_y): r.corr
            for r in profile.correlation_matrix(df, max_pairs_per_pass=4).collect()}
    assert len(one) == 49 and one.keys() == many.keys()
    assert all(one[k] == pytest.approx(many[k]) for k in one)


def test_mix_unit_uses_all_bits_of_the_key(spark):
    from hearth.functions.scalar import mix_unit, mix_unit_sql
    import duckdb
    keys = [5, 5 + 2 ** 31, 5 + 2 ** 33, 5 + 2 ** 62, 2 ** 31 - 1, 2 ** 40 + 7]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in df.select(mix_unit("k", 3)).collect()]
    assert len(set(got)) == len(keys)
    assert got == [duckdb.sql(f"SELECT {mix_unit_sql(str(k), 3)}").fetchall()[0][0] for k in keys]


def test_quantiles_of_heavy_tails_and_infinities(spark):
    import math
    import numpy as np
    from hearth.operators.ranking import column_quantiles
    rng = np.random.default_rng(1)
    values = {"x": 10 ** rng.uniform(-300, 300, 20_000),
              "y": np.concatenate([rng.normal(size=19_990), [math.inf] * 6, [-math.inf] * 4])}
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(*values.values())], "x double, y double")
    probs = [0.0, 0.0001, 0.25, 0.5, 0.75, 1.0]
    found = column_quantiles(df, ["x", "y"], probs, max_fetch=50)
    for c, v in values.items():
        v = np.sort(v)
        for p, got in zip(probs, found[c]):
            h = (len(v) - 1) * p
            a, b = v[math.floor(h)], v[math.ceil(h)]
            want = a if a == b or h == math.floor(h) else a + (h - math.floor(h)) * (b - a)
            assert got == want or got == pytest.approx(want, rel=1e-12)


def test_empty_ranges_and_string_labels(spark):
    from hearth.operators import clean, metrics, profile
    none = spark.createDataFrame([(None, None)], "a double, b double")
    assert profile.histogram_overlay(none, ["a", "b"]).count() == 0
    assert profile.hist2d(none, "a", "b").count() == 0
    flat = spark.createDataFrame([(2.0,), (2.0,)], "a double")
    assert {r.density for r in profile.kde_grid(flat, "a").collect()} == {None}
    words = spark.createDataFrame([("x",), ("y",), ("y",), ("x",)], "label string")
    assert metrics.majority_baseline(words, "label").first().majority_class == "x"
    ids = spark.createDataFrame([(1,), (None,), (2,)], "id long")
    drop = spark.createDataFrame([(1,)], "id long")
    assert clean.exclude_ids(ids, "id", [1]).count() == clean.exclude_ids(ids, "id", drop).count() == 2
