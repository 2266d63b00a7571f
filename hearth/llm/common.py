"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import session
from hearth.session import ship_package


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names; what is
    written there is removed when the application ends."""
    ship_package(spark)
    return session.shared_folder(spark, name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    recomputing ``df``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs: its cleaner waits for
    the driver's garbage collection, which may be far off on an idle driver."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
