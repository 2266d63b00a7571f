"""Queries that fit models (I1-I19, J9). Results depend on numeric
optimisation, so they have no SQL oracle; tests check them against known
signals on small frames."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit
from hearth.operators import features, mlp, models
from hearth.plans.jobs import price_prediction, prepare
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 7
BATCH = 1000      # rows per step of the networks, in each of their partitions
ID = ["l_orderkey", "l_linenumber", "l_partkey"]


def priced_lines(spark, d):
    """lineitem joined to part: the modelling frame of the flagship job.

    A plain equi-join: the planner shuffles both sides on the part key, or
    broadcasts ``part`` when AQE measures it under the broadcast threshold.
    """
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_quantity", "l_discount", "l_extendedprice")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return l.join(p, l.l_partkey == p.p_partkey).drop("p_partkey")


def train_and_score_frames(spark, d):
    """Orders hashed 80/20 into a labelled training frame and a scoring frame
    without the label."""
    j = priced_lines(spark, d)
    u = mix_unit("l_orderkey", SEED)
    train = j.filter(u < 0.8)
    score = j.filter(u >= 0.8).drop("l_extendedprice")
    return train, score


def run_price_prediction(spark, d, grid=None, parallelism=3):
    train, score = train_and_score_frames(spark, d)
    return price_prediction(train, score, id_cols=ID, label="l_extendedprice",
                            categorical=["p_brand", "p_type"], grid=grid, seed=SEED,
                            parallelism=parallelism, out_col="predicted_price")


@query("price_prediction", "B4,B8,E1,E2,E11,E12,H1,I1,I8,I9,J1")
def price_prediction_q(spark, d):
    """The flagship job: predicted price per held-out line item."""
    return run_price_prediction(spark, d).predictions


def _prepared(spark, d, spread: bool = False):
    """Assembled training and scoring rows; ``spread`` for learners that
    make many passes (trees, forests, boosting)."""
    train, score = train_and_score_frames(spark, d)
    tr, te, _, _ = prepare(train, score, id_cols=ID, label="l_extendedprice",
                           categorical=["p_brand", "p_type"])
    return (models.spread_for_fit(tr, ID) if spread else tr), te


def _fit_score(spark, d, est, spread: bool = False):
    tr, te = _prepared(spark, d, spread)
    tr = models.persist_prepared(tr)        # a fit reads it more than once
    model = est.fit(tr)
    tr.unpersist()
    return model.transform(te).select(*ID, "prediction")


@query("lr_predict", "I1,I8")
def lr_predict(spark, d):
    return _fit_score(spark, d, LinearRegression(solver="normal", regParam=0.01,
                                                 elasticNetParam=0.8, maxIter=20))


@query("tree_predict", "I2,I8")
def tree_predict(spark, d):
    est = DecisionTreeRegressor(impurity="variance", maxDepth=5, seed=SEED)
    return _fit_score(spark, d, est, spread=True)


@query("rf_predict", "I3,I8")
def rf_predict(spark, d):
    est = RandomForestRegressor(maxDepth=5, numTrees=10, seed=SEED)
    return _fit_score(spark, d, est, spread=True)


@query("gbt_predict", "I4,I8")
def gbt_predict(spark, d):
    est = GBTRegressor(maxDepth=3, maxIter=5, seed=SEED)
    return _fit_score(spark, d, est, spread=True)


@query("cv_leaderboard", "I5,I6,I7,H3")
def cv_leaderboard(spark, d):
    """Cross-validated search over all 108 maps of the four estimator families
    (5 folds), ranked by mean RMSE."""
    return run_price_prediction(spark, d, grid="full", parallelism=8).leaderboard


@query("test_eval", "J9,J1,J2")
def test_eval(spark, d):
    """Validation RMSE/MSE of the flagship model on held-out orders."""
    tr, _ = _prepared(spark, d)
    tr = models.persist_prepared(tr.withColumn("u", mix_unit("l_orderkey", SEED + 1)))
    model = LinearRegression(solver="normal", regParam=0.001, elasticNetParam=0.8).fit(tr.filter("u < 0.75"))
    err = F.col("label") - F.col("prediction")
    r = model.transform(tr.filter("u >= 0.75")).agg(F.count(F.lit(1)), F.avg(err * err)).first()
    tr.unpersist()
    return spark.createDataFrame([(r[0], r[1] ** 0.5 if r[0] else None, r[1])], "n long, rmse double, mse double")


@query("training_history", "I10,I15")
def training_history(spark, d):
    """Per-iteration objective of an L-BFGS linear fit."""
    tr, _ = _prepared(spark, d)
    tr = models.persist_prepared(tr)
    history = models.fit_linear(tr, max_iter=30, reg=0.01).summary.objectiveHistory
    tr.unpersist()
    return models.training_history(spark, history, "objective")


def _docs(spark, d):
    """All documents with features of their text; labelled ones with ``label``
    and a hash split into train and test, others with split ``unlabelled``."""
    lab = table(spark, d, "labels").select("doc_id", "quality")
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    docs = table(spark, d, "documents").select(
        "doc_id", "lang", "source", F.log1p(F.length(text).cast("double")).alias("x_len"),
        (F.length(F.regexp_replace(text, r"[\p{L}\s]+", "")) / F.greatest(F.length(text), F.lit(1))).alias("x_marks"),
        (F.size(F.array_distinct(words)) / n_words).alias("x_distinct"))
    j = docs.join(lab, "doc_id", "left")
    j, _ = features.string_index(j, ["lang", "source"])
    split = (F.when(F.col("quality").isNull(), "unlabelled")
             .when(mix_unit("doc_id", SEED) < 0.8, "train").otherwise("test"))
    return j.withColumn("label", F.col("quality").cast("double")).withColumn("split", split)


@query("logistic_predict", "I11,B9")
def logistic_predict(spark, d):
    """Quality probability of every document from its text's shape, language and
    source; fitted on the labelled documents of the train split."""
    j = _docs(spark, d)
    enc = OneHotEncoder(inputCols=["lang_Index", "source_Index"],
                        outputCols=["lang_vec", "source_vec"], dropLast=False)
    asm = features.assembler(["x_len", "x_marks", "x_distinct", "lang_vec", "source_vec"])
    from pyspark.ml.classification import LogisticRegression
    pipe = Pipeline(stages=[enc, asm, LogisticRegression(maxIter=50, regParam=0.01)])
    model = pipe.fit(j.filter("split = 'train'"))
    scored = models.positive_probability(model.transform(j))
    return scored.select("doc_id", "split", "quality", F.col("p").alias("p_quality"),
                         F.col("prediction").alias("predicted"))


def _representation_frame(spark, d, q_step=5.0, d_step=2.0):
    """Quantity and discount as floats, bucket indicators and a crossed
    indicator, with a hash train/test flag (orders split 80/20)."""
    l = models.spread_for_fit(table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_discount") * 100).alias("disc_pct"),
        (F.col("l_extendedprice") / 1000.0).alias("label")),
        ["l_orderkey", "l_quantity", "disc_pct", "label"])
    b = features.regular_boundaries_many(l, {"l_quantity": q_step, "disc_pct": d_step})
    qb, db = b["l_quantity"], b["disc_pct"]
    nq, nd = len(qb) + 1, len(db) + 1
    l = l.withColumns({"qb": features.bucket_index("l_quantity", qb),
                       "db": features.bucket_index("disc_pct", db)})
    l = l.withColumn("cell", features.cross_cell("qb", "db", nd))
    l = features.indicator(l, ["qb", "db", "cell"], [nq, nd, nq * nd],
                           ["q_vec", "d_vec", "cell_vec"])
    l = l.withColumn("split", F.when(mix_unit("l_orderkey", SEED) < 0.8, "train")
                                .otherwise("test"))
    # read by one fit and one evaluation per representation
    return models.persist_prepared(l)


def _rmse_pair(frame, cols):
    """Fit on the training rows; train and test RMSE from one grouped pass."""
    asm = features.assembler(cols)
    model = Pipeline(stages=[asm, LinearRegression(solver="normal")]).fit(
        frame.filter(F.col("split") == "train"))
    err = F.col("label") - F.col("prediction")
    r = {row["split"]: row["rmse"] for row in model.transform(frame).groupBy("split")
         .agg(F.sqrt(F.avg(err * err)).alias("rmse")).collect()}
    return r.get("train"), r.get("test")


@query("representation_compare", "I16,E6,E7,E8,E9,B7")
def representation_compare(spark, d):
    """Same two inputs as floats, as bucket indicators and as a crossed
    indicator, compared by train and test RMSE."""
    frame = _representation_frame(spark, d)
    rows = []
    for name, cols in (("float", ["l_quantity", "disc_pct"]), ("buckets", ["q_vec", "d_vec"]),
                       ("cross", ["cell_vec"])):
        tr, te = _rmse_pair(frame, cols)
        rows.append((name, tr, te))
    frame.unpersist()
    return spark.createDataFrame(rows, "representation string, train_rmse double, test_rmse double")


def _embedding_frames(spark, d):
    e = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.col("label").cast("double").alias("y"))
    u = mix_unit("row_id", SEED)
    return e.filter(u < 0.8), e.filter(u >= 0.8)


@query("mlp_predict", "I12")
def mlp_predict(spark, d):
    """20-12 relu network regressing the label on the embedding."""
    train, test = _embedding_frames(spark, d)
    model = mlp.fit_mlp(train, hidden=(20, 12), epochs=20, learning_rate=0.01,
                        batch_size=BATCH, seed=SEED)
    return model.transform(test).select("row_id", "y", "prediction")


@query("mlp_history", "I13,I15")
def mlp_history(spark, d):
    """The regularised network (L2 0.04, dropout 0.25): training MSE per epoch,
    then one row with its MSE on the held-out rows."""
    train, test = _embedding_frames(spark, d)
    model = mlp.fit_mlp(train, hidden=(20, 12), epochs=140, learning_rate=0.007, l2=0.04,
                        dropout=0.25, batch_size=BATCH, seed=SEED)
    held_out = model.transform(test).agg(
        F.lit(len(model.history)).alias("epoch"), F.lit("test_mse").alias("metric"),
        F.avg(F.pow(F.col("prediction") - F.col("y"), 2)).alias("value"))
    return models.training_history(spark, model.history, "mse").unionByName(held_out)


@query("mlp_topology", "I14")
def mlp_topology(spark, d):
    """20-12 vs 10-6 hidden units by train and test MSE."""
    train, test = _embedding_frames(spark, d)
    rows = mlp.topology_leaderboard(train, test, [(20, 12), (10, 6)], epochs=20,
                                    learning_rate=0.01, batch_size=BATCH, seed=SEED)
    return spark.createDataFrame(rows, "topology string, train_mse double, test_mse double")
