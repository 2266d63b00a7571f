import tempfile

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hearth.operators.features import assembler
from hearth.streaming import score_stream


def test_score_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="hearth-src-")
    out = tempfile.mkdtemp(prefix="hearth-out-")
    ck = tempfile.mkdtemp(prefix="hearth-ck-")
    df = spark.range(200).select(F.col("id").alias("Id"), F.col("id").cast("double").alias("x"))
    train = df.withColumn("label", F.log1p(F.col("x") * 3 + 10))
    model = Pipeline(stages=[assembler(["x"]), LinearRegression()]).fit(train)
    df.write.mode("overwrite").parquet(src)
    q = score_stream(spark, model, src, df.schema, out, id_cols=["Id"], checkpoint=ck,
                     query_name="t_scoring")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = model.transform(df).select("Id", F.expm1("prediction").alias("prediction"))
    assert got.count() == 200
    assert got.join(want, "Id").filter(F.abs(got.prediction - want.prediction) > 1e-9).count() == 0


def test_score_stream_csv(spark):
    src = tempfile.mkdtemp(prefix="hearth-csvsrc-")
    out = tempfile.mkdtemp(prefix="hearth-csvout-")
    ck = tempfile.mkdtemp(prefix="hearth-csvck-")
    df = spark.range(50).select(F.col("id").alias("Id"), F.col("id").cast("double").alias("x"))
    model = Pipeline(stages=[assembler(["x"]), LinearRegression()]).fit(
        df.withColumn("label", F.col("x") * 2.0))
    df.write.mode("overwrite").option("header", True).csv(src)
    q = score_stream(spark, model, src, df.schema, out, id_cols=["Id"], fmt="csv",
                     back_transform=False, checkpoint=ck, query_name="t_csv_scoring")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 50
