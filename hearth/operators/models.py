"""Estimators, parameter grids, cross-validation, scoring.

Spark ML does the distributed work: linear models solve with the normal
equations or L-BFGS/OWL-QN over ``treeAggregate``; trees grow from binned
sufficient statistics. Prepared rows are persisted once before a search so
every fold and the refit read the same assembled vectors.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                   LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearth.functions.scalar import expm1

# The reference job's search space.
GRID_LR_MAX_ITER = (10, 20, 30)
GRID_LR_REG_PARAM = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)
GRID_LR_ELASTIC_NET = (0.7, 0.8, 0.9)
GRID_DT_MAX_DEPTH = (2, 3, 5, 10)
GRID_RF_MAX_DEPTH = (2, 3, 5, 10)
GRID_RF_NUM_TREES = (5, 10, 15, 20)
GRID_GBT_MAX_DEPTH = (1, 2, 3, 4, 5)
GRID_GBT_MAX_ITER = (1, 2, 3, 4, 5)


def regressors(features: str = "features", label: str = "label", seed: int = 7,
               max_bins: int = 32) -> dict:
    """The four regression estimators of the search (I1-I4). ``max_bins``
    must cover the largest category count of nominal features."""
    return {
        "linear": LinearRegression(featuresCol=features, labelCol=label),
        "tree": DecisionTreeRegressor(featuresCol=features, labelCol=label,
                                      impurity="variance", seed=seed, maxBins=max_bins),
        "forest": RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed,
                                        maxBins=max_bins),
        "boosted": GBTRegressor(featuresCol=features, labelCol=label, seed=seed,
                                maxBins=max_bins),
    }


def search_grid(pipeline: Pipeline, est: Mapping[str, object], size: str = "full") -> list:
    """Multi-estimator grid through the pipeline's ``stages`` param.

    ``full`` is the reference space: GBT 25 + RF 16 + LR 63 + DT 4 = 108
    maps. ``smoke`` keeps one or two values per axis (6 maps).
    """
    lr, dt, rf, gbt = est["linear"], est["tree"], est["forest"], est["boosted"]
    if size == "full":
        axes = dict(lr_it=GRID_LR_MAX_ITER, lr_reg=GRID_LR_REG_PARAM, lr_en=GRID_LR_ELASTIC_NET,
                    dt_d=GRID_DT_MAX_DEPTH, rf_d=GRID_RF_MAX_DEPTH, rf_n=GRID_RF_NUM_TREES,
                    gbt_d=GRID_GBT_MAX_DEPTH, gbt_it=GRID_GBT_MAX_ITER)
    elif size == "smoke":
        axes = dict(lr_it=(20,), lr_reg=(0.001, 0.1), lr_en=(0.8,), dt_d=(3, 5),
                    rf_d=(5,), rf_n=(10,), gbt_d=(3,), gbt_it=(5,))
    else:
        raise ValueError("size must be 'full' or 'smoke'")
    g_gbt = (ParamGridBuilder().baseOn({pipeline.stages: [gbt]})
             .addGrid(gbt.maxDepth, list(axes["gbt_d"])).addGrid(gbt.maxIter, list(axes["gbt_it"])).build())
    g_rf = (ParamGridBuilder().baseOn({pipeline.stages: [rf]})
            .addGrid(rf.maxDepth, list(axes["rf_d"])).addGrid(rf.numTrees, list(axes["rf_n"])).build())
    g_lr = (ParamGridBuilder().baseOn({pipeline.stages: [lr]})
            .addGrid(lr.maxIter, list(axes["lr_it"])).addGrid(lr.regParam, list(axes["lr_reg"]))
            .addGrid(lr.elasticNetParam, list(axes["lr_en"])).build())
    g_dt = (ParamGridBuilder().baseOn({pipeline.stages: [dt]})
            .addGrid(dt.maxDepth, list(axes["dt_d"])).build())
    return g_gbt + g_rf + g_lr + g_dt


def cross_validate(data: DataFrame, pipeline: Pipeline, grid: list, *, folds: int = 5,
                   parallelism: int = 3, seed: int = 7, fold_col: str | None = None,
                   label: str = "label", metric: str = "rmse") -> CrossValidatorModel:
    """k-fold cross-validation over ``grid`` (I6) and refit of the winner."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=ev,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(data)


def _describe_map(pm: dict) -> tuple[str, str]:
    est, params = "", []
    for p, v in pm.items():
        if p.name == "stages":
            est = type(v[0]).__name__
        else:
            params.append(f"{p.name}={v}")
    return est, ",".join(sorted(params))


def rank_maps(spark: SparkSession, grid: Sequence[dict], avg: Sequence[float], std: Sequence[float | None],
              larger_better: bool = False) -> DataFrame:
    """(rank, estimator, params, avg_metric, std_metric), best first (I7): for
    RMSE the smallest is rank 1. One row per map (the grid size bounds it)."""
    rows = [(*_describe_map(pm), float(m), None if sd is None else float(sd)) for pm, m, sd in zip(grid, avg, std)]
    rows.sort(key=lambda r: (-r[2] if larger_better else r[2], r[0], r[1]))
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)],
                                 "rank int, estimator string, params string, "
                                 "avg_metric double, std_metric double")


def leaderboard(spark: SparkSession, cv_model: CrossValidatorModel, grid: list) -> DataFrame:
    """The ranked maps of a fitted cross-validator, by its evaluator's direction."""
    stds = cv_model.stdMetrics or [None] * len(grid)
    return rank_maps(spark, grid, cv_model.avgMetrics, stds, cv_model.getEvaluator().isLargerBetter())


def score(model, df: DataFrame) -> DataFrame:
    """Batch scoring (I8)."""
    return model.transform(df)


def back_transform(scored: DataFrame, id_col: str, pred_col: str = "prediction",
                   out: str = "PredictedSalePrice") -> DataFrame:
    """Prediction table on the original scale, e^p - 1."""
    return scored.select(id_col, expm1(pred_col).alias(out))


def fit_linear(df: DataFrame, features: str = "features", label: str = "label",
               max_iter: int = 100, reg: float = 0.0, elastic_net: float = 0.0,
               solver: str = "l-bfgs"):
    """Linear model with squared loss (I10): the optimum that the notebooks'
    SGD epochs approach; epochs become ``maxIter``."""
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg, elasticNetParam=elastic_net, solver=solver).fit(df)


def fit_logistic(df: DataFrame, features: str = "features", label: str = "label",
                 max_iter: int = 100, reg: float = 0.0):
    """One sigmoid unit with binary cross-entropy."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                              regParam=reg).fit(df)


def cell_mean_errors(df: DataFrame, keys: Sequence[str], cell: str, label: str, is_train) -> DataFrame:
    """(``keys``, n_cells, train_rmse, test_rmse) of linear models on one
    crossed indicator each (I17): the least-squares fit is the mean of every
    cell's training labels, so no solver and no bound on the cells is needed.

    A cell without training rows answers with the mean over all training rows
    of its key. One shuffle on (keys, cell) of partial moments, then one on
    the keys; null labels are left out, and a side without rows gives null.
    """
    y, tr = F.col(label).cast("double"), is_train
    cells = df.where(y.isNotNull()).groupBy(*keys, cell).agg(
        F.count_if(tr).alias("_n"), F.avg(F.when(tr, y)).alias("_m"), F.var_pop(F.when(tr, y)).alias("_v"),
        F.count_if(~tr).alias("_tn"), F.avg(F.when(~tr, y)).alias("_tm"), F.var_pop(F.when(~tr, y)).alias("_tv"))
    seen, n, tn, tm = F.col("_n") > 0, F.col("_n"), F.col("_tn"), F.col("_tm")
    per_key = cells.groupBy(*keys).agg(
        F.count_if(seen).alias("n_cells"), F.sum("_n").alias("n"), F.sum("_tn").alias("tn"),
        F.try_divide(F.sum(n * F.col("_m")), F.sum("_n")).alias("mean"),
        F.sum(n * F.col("_v")).alias("sse"),
        F.sum(F.when(seen, tn * (F.col("_tv") + F.pow(tm - F.col("_m"), 2)))).alias("t_sse"),
        # test rows of cells the fit has not seen: their moments about zero
        F.sum(F.when(~seen, tn)).alias("un"), F.sum(F.when(~seen, tn * tm)).alias("us"),
        F.sum(F.when(~seen, tn * (F.col("_tv") + tm * tm))).alias("uss"))

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0.0))
    unseen = zero("uss") - 2 * zero("mean") * zero("us") + zero("mean") ** 2 * zero("un")
    return per_key.select(*keys, "n_cells", F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("train_rmse"),
                          F.when(F.col("n") > 0, F.sqrt(F.try_divide(zero("t_sse") + unseen, F.col("tn"))))
                           .alias("test_rmse"))


def positive_probability(scored: DataFrame, prob_col: str = "probability",
                         out: str = "p") -> DataFrame:
    """P(class 1) as a double column."""
    from pyspark.ml.functions import vector_to_array
    return scored.withColumn(out, vector_to_array(F.col(prob_col))[1])


def training_history(spark: SparkSession, history: Sequence[float],
                     metric: str = "objective") -> DataFrame:
    """Per-iteration loss as (epoch, metric, value)."""
    return spark.createDataFrame([(i + 1, metric, float(v)) for i, v in enumerate(history)],
                                 "epoch int, metric string, value double")


def fit_partitions(rows: int) -> int:
    """Partitions for a fit over so many rows: a million rows each, and for
    tables below 32 million up to 32 of at least 60,000."""
    return max(-(-rows // 1_000_000), min(-(-rows // 60_000), 32), 1)


def spread_for_fit(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The same rows in the same partitions on any cluster, for learners that
    draw per partition (forests, boosting): dealt by a hash of ``keys`` and
    sorted inside the partitions. Their number follows from the number of rows
    alone (one count, unless ``partitions`` is given).
    """
    if partitions is None:
        partitions = fit_partitions(df.count())
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def persist_prepared(df: DataFrame) -> DataFrame:
    """Keep assembled rows for repeated fits; spills to disk when needed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def save_model(model, path: str) -> None:
    """Persist a fitted model or pipeline."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
