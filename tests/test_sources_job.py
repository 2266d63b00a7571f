"""CSV sources in both NA modes and the end-to-end job with its sinks."""

import os
import tempfile

import numpy as np
import pytest

from hearth.plans.jobs import price_prediction, run_job
from hearth.session import shared_folder


def _write_housing(d, n=300):
    rng = np.random.default_rng(5)
    with open(os.path.join(d, "train.csv"), "w") as f:
        f.write("Id,LotFrontage,GrLivArea,TotalBsmtSF,Neighborhood,Electrical,PoolQC,SalePrice\n")
        for i in range(1, n + 1):
            area = int(rng.integers(600, 3000))
            bsmt = 0 if i % 10 == 0 else int(rng.integers(300, 1500))
            lf = "NA" if i % 6 == 0 else str(int(rng.integers(40, 120)))
            elec = "NA" if i == 11 else "SBrkr"
            price = 15000 + 70 * area + 20 * bsmt
            f.write(f"{i},{lf},{area},{bsmt},{['A', 'B', 'C'][i % 3]},{elec},NA,{price}\n")
    with open(os.path.join(d, "test.csv"), "w") as f:
        f.write("Id,LotFrontage,GrLivArea,TotalBsmtSF,Neighborhood,Electrical,PoolQC\n")
        for i, area in enumerate([900, 1500, 2500]):
            bsmt = "NA" if i == 1 else "800"  # a numeric gap only in the scoring file
            f.write(f"{1461 + i},NA,{area},{bsmt},B,SBrkr,NA\n")


def test_run_job_writes_all_sinks(spark):
    for na_mode in ("literal", "null"):
        d = tempfile.mkdtemp(prefix="hearth-job-")
        _write_housing(d)
        out = os.path.join(d, "out")
        res = run_job(spark, os.path.join(d, "train.csv"), os.path.join(d, "test.csv"), out,
                      na_mode=na_mode, run_id="r1")
        pred = spark.read.parquet(f"{out}/predictions")
        sub = spark.read.option("header", True).csv(f"{out}/submission")
        rep = {r.name: r.value for r in spark.read.parquet(f"{out}/report").collect()}
        assert pred.count() == 3 and sub.columns == ["Id", "SalePrice"]
        assert float(rep["validation_rmse"]) == res.validation_rmse
        vals = sorted(r.PredictedSalePrice for r in pred.collect())
        assert vals[0] < vals[1] < vals[2]


def test_exploration_job_on_lineitem(spark):
    from pyspark.sql import functions as F
    from hearth.plans.jobs import exploration_job
    from hearth.sources.tables import table
    li = table(spark, "/root/testdata/sf0.001", "lineitem").select(
        F.monotonically_increasing_id().alias("row_id"), "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    li = li.withColumn("l_tax", F.when(F.col("l_discount") < 0.01, None).otherwise(F.col("l_tax")))
    out = exploration_job(li, label="l_extendedprice", x="l_quantity", id_col="row_id",
                          impute_cols=["l_tax"], ratios={"unit_price": ("l_extendedprice", "l_quantity")},
                          category="l_returnflag")
    n = li.count()
    assert out["test_errors"].first().n == n - int(0.75 * n)
    assert out["summary"].count() == 4
    assert out["histograms"].groupBy("column").agg(F.sum("count")).count() == 4
    box_cols = {r["column"] for r in out["box"].collect()}
    assert {"A", "N", "R", "unit_price"} <= box_cols  # one-hot and ratio columns profiled
    assert out["ols_all_confint"].count() == 2


def test_classification_job_on_lineitem(spark):
    from pyspark.sql import functions as F
    from hearth.functions.scalar import mix_unit
    from hearth.plans.jobs import classification_job
    from hearth.sources.tables import table
    li = table(spark, "/root/testdata/sf0.01", "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_discount") * 100).alias("disc"), "l_tax",
        "l_extendedprice")
    u = mix_unit("l_orderkey", 5)
    out = classification_job(li.filter(u < 0.8), li.filter(u >= 0.8), value="l_extendedprice",
                             lat="l_quantity", lon="disc", numeric=["l_tax"], step=5.0,
                             max_iter=20)
    sw = out["sweep"].collect()
    assert len(sw) == 3 and sum(r.best for r in sw) == 1
    assert 0 <= out["auc"].first().auc <= 1
    assert out["history"].count() > 0
    assert abs(out["baseline"].first().baseline_accuracy - 0.75) < 0.02


def test_command_line_predict(spark):
    from hearth.__main__ import main
    d = tempfile.mkdtemp(prefix="hearth-cli-")
    _write_housing(d)
    out = os.path.join(d, "out")
    assert main(["predict", os.path.join(d, "train.csv"), os.path.join(d, "test.csv"), out,
                 "--na-mode", "null", "--run-id", "cli"]) == 0
    assert spark.read.parquet(f"{out}/predictions").count() == 3


def test_too_many_levels_are_refused_before_they_are_gathered(spark):
    train = spark.range(400).selectExpr("id", "concat('k', id) AS c", "CAST(id AS double) AS x", "CAST(id + 1 AS double) AS y")
    with pytest.raises(ValueError, match="levels"):
        price_prediction(train, train.drop("y"), id_cols=["id"], label="y", max_levels=100)


def test_staged_copies_are_registered_for_removal(spark):
    path = shared_folder(spark, "made")
    spark.range(3).write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(where) and fs.cancelDeleteOnExit(where)
    fs.delete(where, True)
