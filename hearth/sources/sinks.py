"""Result sinks (A5-A7): complete tables written by the executors."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_predictions(pred: DataFrame, path: str, *, fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Write every scored row (not only what ``show`` would print)."""
    writer = pred.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_submission(pred: DataFrame, path: str, *, id_col: str = "Id",
                     pred_col: str = "PredictedSalePrice") -> None:
    """Submission layout ``(Id, SalePrice)`` as headed CSV."""
    out = pred.select(F.col(id_col).alias("Id"),
                      F.col(pred_col).alias("SalePrice"))
    out.write.mode("overwrite").option("header", True).csv(path)


def run_report(spark: SparkSession, metrics: dict[str, object],
               run_id: str | None = None) -> DataFrame:
    """One row per reported metric/parameter, stamped with a run id.

    The metric dict is small and bounded (a handful of names).
    """
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime(
        "%Y%m%dT%H%M%S")
    rows = [(run_id, str(k), str(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, name string, value string")


def write_report(report: DataFrame, path: str) -> None:
    """Append a run report, partitioned by run id."""
    report.write.mode("append").partitionBy("run_id").parquet(path)


def write_bucketed(df: DataFrame, table_name: str, key: str, buckets: int,
                   path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted on ``key`` at ``path``
    (shared storage) and return its scan.

    Two tables bucketed on the join key with the same bucket count join
    without an exchange on either side: written once, the layout serves
    every later join (model fits, cross-validation folds, scoring).
    """
    (df.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key)
       .option("path", path).saveAsTable(table_name))
    return df.sparkSession.table(table_name)
