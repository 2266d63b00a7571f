"""End-to-end jobs assembled only from the operators.

``price_prediction`` is the batch prediction job: clean -> log -> index ->
assemble -> (cross-validated) regression -> validation RMSE -> scored table
on the original scale.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from hearth.functions.scalar import expm1, unit_hash
from hearth.operators import clean, columns, features, models, sampling, search


@dataclass
class PricePredictionResult:
    predictions: DataFrame
    model: object
    validation_rmse: float
    leaderboard: DataFrame | None
    feature_columns: list[str]


def prepare(train: DataFrame, test: DataFrame, *, id_cols: Sequence[str], label: str,
            drop: Sequence[str] = (), marker_col: str | None = None,
            exclude: Sequence | DataFrame | None = None, exclude_col: str | None = None,
            log_cols: Sequence[str] = (), categorical: Sequence[str] | None = None,
            handle_invalid: str = "error", impute_numeric: bool = False, max_levels: int | None = None):
    """Shared preparation of the training and scoring frames.

    Indexes are fitted once on the training frame and reused for the test
    frame (unseen levels get their own code), so both use the same codes.
    With ``impute_numeric`` (files read with ``NA`` as null), numeric
    features holding nulls in either frame get the training median. With
    ``max_levels`` a category with more distinct values raises ValueError
    before its domain is gathered (one more scan of ``train``).
    """
    train = columns.drop_columns(train, drop)
    test = columns.drop_columns(test, drop)
    test = _align_types(test, train)
    if marker_col:
        train = clean.drop_missing_marker(train, marker_col)
    if exclude is not None:
        train = clean.exclude_ids(train, exclude_col or id_cols[0], exclude)
    train = features.log1p_columns(train, [label, *log_cols])
    test = features.log1p_columns(test, list(log_cols))
    skip = [*id_cols, label]
    cats = list(categorical) if categorical is not None else columns.columns_of_kind(train, "string", skip)
    if max_levels is not None:
        features.check_levels(train, cats, max_levels)
    indexer = features.string_indexer(cats)
    idx_model = indexer.fit(train)
    train = idx_model.transform(train).drop(*cats)
    test = idx_model.transform(test).drop(*cats)
    feats = [c for c in train.columns if c not in skip]
    if impute_numeric:
        numeric = set(columns.columns_of_kind(train, "numeric"))
        train, test = _impute_numeric(train, test, [c for c in feats
                                                    if c in numeric and c in test.columns])
    asm = features.assembler(feats, handle_invalid=handle_invalid)
    train = columns.rename_positional(asm.transform(train), [*id_cols, "features", label],
                                      [*id_cols, "features", "label"])
    test = asm.transform(test).select(*id_cols, "features")
    return train, test, feats, idx_model


def _align_types(test: DataFrame, train: DataFrame) -> DataFrame:
    """Give the scoring frame the training frame's column types.

    With inferred CSV types, a numeric column that holds the ``NA`` token
    only in the scoring file arrives as a string there; ``try_cast`` turns
    the token into null and keeps the numbers.
    """
    want = {f.name: f.dataType for f in train.schema.fields}
    fix = {f.name: F.col(f.name).try_cast(want[f.name]) for f in test.schema.fields
           if f.name in want and f.dataType != want[f.name]}
    return test.withColumns(fix) if fix else test


def _impute_numeric(train: DataFrame, test: DataFrame, cols: Sequence[str]):
    """Training medians into the nulls of numeric feature columns of both
    frames; one null-count aggregate per frame picks the columns."""
    from hearth.operators.ranking import column_quantiles
    holes = set()
    for frame in (train, test):
        row = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        holes |= {c for c in cols if row[c]}
    if not holes:
        return train, test
    med = column_quantiles(train, sorted(holes), [0.5])
    fill = {c: F.coalesce(F.col(c), F.lit(med[c][0]).cast(train.schema[c].dataType))
            for c in holes if med[c][0] is not None}
    return train.withColumns(fill), test.withColumns(fill)


def level_count(idx_model) -> int:
    """Largest category count of a fitted indexer, +1 for the unseen code."""
    return max((len(labels) for labels in idx_model.labelsArray), default=0) + 1


def price_prediction(train: DataFrame, test: DataFrame, *, id_cols: Sequence[str], label: str,
                     drop: Sequence[str] = (), marker_col: str | None = None,
                     exclude: Sequence | DataFrame | None = None, exclude_col: str | None = None,
                     log_cols: Sequence[str] = (), categorical: Sequence[str] | None = None,
                     estimator=None, grid: str | None = None, folds: int = 5,
                     parallelism: int = 3, split: Sequence[float] = (0.9, 0.2),
                     split_key: Column | None = None, seed: int = 7,
                     impute_numeric: bool = False,
                     out_col: str = "PredictedSalePrice",
                     fit_partitions: int | None = None, max_levels: int = 100_000) -> PricePredictionResult:
    """The batch prediction job.

    ``grid=None`` fits ``estimator`` (default: elastic-net linear regression
    solved from the normal equations, one pass over the data); ``'smoke'`` (6
    maps) or ``'full'`` (the 108 maps) runs the multi-estimator cross-validated
    search, whose work the maps share (:mod:`hearth.operators.search`), and fits
    the best map on all training rows. The validation split is a hash split
    with weights normalised to sum 1. ``fit_partitions`` follows from the
    number of rows if not given. More than ``max_levels`` values of a category
    raise ValueError.
    """
    # The training rows feed the indexer fit, the model fit and the
    # validation pass; keep them once instead of re-reading (and re-joining)
    # the sources three times. Lost blocks are recomputed from lineage.
    train = models.persist_prepared(models.spread_for_fit(train, [id_cols] if isinstance(id_cols, str) else list(id_cols), fit_partitions))
    tr, te, feats, idx_model = prepare(train, test, id_cols=id_cols, label=label, drop=drop,
                                       marker_col=marker_col, exclude=exclude,
                                       exclude_col=exclude_col, log_cols=log_cols,
                                       categorical=categorical, impute_numeric=impute_numeric,
                                       max_levels=max_levels)
    # indexed columns carry nominal metadata, so trees need maxBins >= levels
    bins = max(32, level_count(idx_model))
    key = split_key if split_key is not None else unit_hash(F.xxhash64(*id_cols), seed)
    tr = tr.withColumn("_u", key)
    fit_set, valid = sampling.weighted_split(tr, list(split), "_u", seed, draw=F.col("_u"))
    fit_set, valid = fit_set.drop("_u"), valid.drop("_u")
    board = None
    if grid:
        est = models.regressors(seed=seed, max_bins=bins)
        pipe = Pipeline(stages=[])
        maps = models.search_grid(pipe, est, grid)
        prepared = models.persist_prepared(
            sampling.fold_column(fit_set, folds, "_k", seed,
                                 draw=unit_hash(F.xxhash64(*id_cols), seed + 1)))
        errors = search.shared_search(prepared, maps, parallelism=parallelism)
        avg, std = errors.mean(axis=1), errors.std(axis=1)
        board = models.rank_maps(train.sparkSession, maps, avg, std)
        model = search.fit_map(prepared, *search.parameter_maps(maps)[int(avg.argmin())])
    else:
        est = estimator or LinearRegression(solver="normal", maxIter=30, regParam=0.001,
                                            elasticNetParam=0.8)
        model = est.fit(fit_set)
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    rmse = ev.evaluate(model.transform(valid))
    if grid:
        prepared.unpersist()
    train.unpersist()
    pred = model.transform(te).select(*id_cols, expm1("prediction").alias(out_col))
    return PricePredictionResult(pred, model, rmse, board, feats)


# The columns the reference job drops before modelling (one of
# them, 1stFloor, does not exist in the files; dropping it is a no-op).
HOUSING_DROP = ("1stFlrSF", "GarageYrBlt", "GarageArea", "1stFloor", "TotRmsAbvGrd", "PoolQC",
                "MiscFeature", "Alley", "Fence", "FireplaceQu", "LotFrontage", "GarageCond",
                "GarageType", "GarageFinish", "GarageQual", "BsmtExposure", "BsmtFinType2",
                "BsmtFinType1", "BsmtCond", "BsmtQual", "MasVnrArea", "MasVnrType")
HOUSING_OUTLIER_IDS = (1299, 524)


def run_job(spark, train_path: str, test_path: str, out_path: str, *, na_mode: str = "literal",
            grid: str | None = None, seed: int = 7, run_id: str | None = None,
            train_schema=None, test_schema=None) -> PricePredictionResult:
    """The housing job end to end: CSV in (A1-A4), predictions, submission
    and a run report out (A5-A7), all written by the executors."""
    from hearth.sources.csv import read_csv
    from hearth.sources.sinks import run_report, write_predictions, write_report, write_submission
    train = read_csv(spark, train_path, na_mode=na_mode, schema=train_schema)
    test = read_csv(spark, test_path, na_mode=na_mode, schema=test_schema)
    res = price_prediction(train, test, id_cols=["Id"], label="SalePrice", drop=HOUSING_DROP,
                           marker_col="Electrical", exclude=list(HOUSING_OUTLIER_IDS),
                           log_cols=["GrLivArea", "TotalBsmtSF"], grid=grid, seed=seed,
                           impute_numeric=True)
    base = out_path.rstrip("/")
    write_predictions(res.predictions, f"{base}/predictions")
    write_submission(res.predictions, f"{base}/submission")
    report = {"validation_rmse": res.validation_rmse, "grid": grid or "none", "seed": seed,
              "n_features": len(res.feature_columns)}
    if res.leaderboard is not None:
        best = res.leaderboard.orderBy("rank").first()
        report.update({"best_estimator": best["estimator"], "best_params": best["params"]})
    write_report(run_report(spark, report, run_id), f"{base}/report")
    return res


def exploration_job(df: DataFrame, *, label: str, x: str, id_col: str,
                    impute_cols: Sequence[str] = (), ratios: dict | None = None,
                    drop: Sequence[str] = (), category: str | None = None,
                    n_bins: int = 30, corr_cut: float = 0.60, train_share: float = 0.75,
                    seed: int = 111) -> dict[str, DataFrame]:
    """The exploration script as one job: profile, distributions, repairs,
    correlations and simple least squares with inference, then an exact
    train/test split, refit and test errors. Returns named result tables.

    Test errors are computed on the test rows only (actual and prediction
    side by side), not against the full label column.
    """
    from hearth.operators import metrics, ols, profile
    out: dict[str, DataFrame] = {}
    out["schema"] = columns.schema_profile(df)
    out["head"] = columns.head_rows(df, 6, [id_col])
    nums = columns.columns_of_kind(df, "numeric", exclude=[id_col])
    out["summary"] = profile.r_summary(df, nums)
    for c in columns.columns_of_kind(df, "string"):
        out[f"levels_{c}"] = profile.level_counts(df, c)
    hist = [profile.histogram(df, c, n_bins).withColumn("column", F.lit(c)) for c in nums]
    if hist:
        merged = hist[0]
        for h in hist[1:]:
            merged = merged.unionByName(h)
        out["histograms"] = merged
    work = clean.impute_median(df, list(impute_cols)) if impute_cols else df
    if ratios:
        work = columns.add_ratios(work, ratios, drop=drop)
    elif drop:
        work = columns.drop_columns(work, drop)
    if category:
        work = clean.one_hot_columns(work, category)
    nums = columns.columns_of_kind(work, "numeric", exclude=[id_col])
    out["box"] = profile.box_stats(work, nums)
    out["scatter_bins"] = profile.hist2d(work, x, label)
    corr = profile.correlation_matrix(work, nums)
    out["correlation"] = corr
    out["correlated_with_label"] = profile.correlated_with(corr, label, corr_cut)
    fit_all = ols.fit_simple_ols(work, label, x)
    out["ols_all"] = ols.coefficient_table(work, label, x)
    out["ols_all_summary"] = ols.fit_statistics(work, fit_all)
    out["ols_all_confint"] = ols.confint(work, label, x)
    out["ols_all_line"] = ols.fitted_line(work, fit_all)
    flagged = sampling.exact_sample(work, train_share, id_col, seed)
    train = flagged.filter(F.col("in_sample"))
    test = flagged.filter(~F.col("in_sample"))
    fit = ols.fit_simple_ols(train, label, x)
    out["ols_train"] = ols.coefficient_table(train, label, x)
    out["ols_train_confint"] = ols.confint(train, label, x)
    scored = ols.predict(test, fit, "prediction")
    out["test_predictions"] = metrics.residuals(scored, id_col, label, "prediction")
    out["overlay"] = profile.histogram_overlay(scored, [label, "prediction"], n_bins)
    out["test_errors"] = metrics.regression_metrics(scored, label, "prediction")
    return out


def classification_job(train: DataFrame, test: DataFrame, *, value: str, lat: str, lon: str,
                       numeric: Sequence[str], step: float = 1.0, hash_bins: int = 100,
                       quantile: float = 0.75, threshold: float = 0.35,
                       sweep: Sequence[float] = (0.3, 0.52, 0.8), max_iter: int = 100,
                       own_stats: bool = False) -> dict[str, DataFrame]:
    """The classification notebook as one job.

    * Label: 1.0 when ``value`` exceeds its q75, computed per frame.
    * Numeric features: z-scored with the training statistics, or with each
      frame's own statistics when ``own_stats`` is set.
    * ``lat``/``lon``: bucketised on regular boundaries taken from the raw
      columns, hashed-crossed into ``hash_bins`` and one-hot encoded.
    * Model: logistic regression.
    * Outputs: history, threshold metrics, sweep, 100-threshold AUC and the
      majority baseline on the test frame.

    The notebook's random row shuffle is not needed: the fit is full-batch.
    """
    from pyspark.ml.classification import LogisticRegression
    from hearth.operators import metrics, profile
    out: dict[str, DataFrame] = {"describe_train": profile.describe(train, [value, *numeric])}
    stats = features.zscore_stats(train, list(numeric))
    tr = features.zscore(train, list(numeric), stats=None if own_stats else stats)
    te = features.zscore(test, list(numeric), stats=None if own_stats else stats)
    tr = features.quantile_label(tr, value, quantile, "label")
    te = features.quantile_label(te, value, quantile, "label")
    out["correlation_train"] = profile.correlation_matrix(tr, [*numeric, "label"])
    b = features.regular_boundaries_many(train, {lat: step, lon: step})

    def encode(frame):
        f = frame.withColumns({"_blat": features.bucket_index(lat, b[lat]),
                               "_blon": features.bucket_index(lon, b[lon])})
        f = f.withColumn("_cross", features.hashed_cross("_blat", "_blon", hash_bins))
        return features.indicator(f, ["_cross"], [hash_bins], ["_cross_vec"])

    asm = features.assembler(["_cross_vec", *numeric])
    tr, te = asm.transform(encode(tr)), asm.transform(encode(te))
    model = LogisticRegression(maxIter=max_iter).fit(tr)
    from hearth.operators.models import positive_probability, training_history
    out["history"] = training_history(train.sparkSession, model.summary.objectiveHistory, "loss")
    scored = positive_probability(model.transform(te))
    out["test_metrics"] = metrics.threshold_metrics(scored, "label", "p", threshold)
    out["sweep"] = metrics.threshold_sweep(scored, "label", "p", list(sweep))
    out["auc"] = metrics.roc_auc(scored, "label", "p", 100)
    out["baseline"] = metrics.majority_baseline(te, "label")
    return out
