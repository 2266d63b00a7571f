"""Model queries whose fit has a closed form, so SQL can state the result:
the two-feature linear model (I1, I8, I19, J9), the one-split tree (I2) and
crossed indicators at several resolutions (I17)."""

from __future__ import annotations


from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators import features, models
from hearth.plans.registry import query
from hearth.session import shared_folder
from hearth.sources.sinks import run_report, write_report
from hearth.sources.tables import table

SEED = 7
ID = ["l_orderkey", "l_linenumber"]
_DRAW = mix_unit_sql("l_orderkey", SEED)

# price in thousands by quantity and discount in percent, least squares on the train rows
_TWO_SQL = f"""
li AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount * 100 AS z,
              l_extendedprice / 1000.0 AS y,
              CASE WHEN {_DRAW} < 0.8 THEN 'train' ELSE 'test' END AS split
       FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS vx, var_pop(z) AS vz,
             covar_pop(x, z) AS cxz, covar_pop(x, y) AS cxy, covar_pop(z, y) AS czy
      FROM li WHERE split = 'train'),
fit AS (SELECT mx, mz, my, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS bx,
               (czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS bz FROM m),
scored AS (SELECT li.*, my + bx * (x - mx) + bz * (z - mz) AS pred FROM li, fit)"""


def _lines(spark, d):
    """Line items with two numeric inputs, the label and the split of their order."""
    l = table(spark, d, "lineitem").select(
        *ID, "l_quantity", (F.col("l_discount") * 100).alias("disc_pct"),
        (F.col("l_extendedprice") / 1000.0).alias("label"))
    return l.withColumn("split", F.when(mix_unit("l_orderkey", SEED) < 0.8, "train").otherwise("test"))


def _two_feature_fit(spark, d):
    frame = features.assemble(_lines(spark, d), ["l_quantity", "disc_pct"])
    model = Pipeline(stages=[LinearRegression(solver="normal")]).fit(
        frame.filter("split = 'train'").select("features", "label"))
    return frame, model


@query("lr_two_features", "I1,I8", f"""
WITH {_TWO_SQL.strip()}
SELECT l_orderkey, l_linenumber, round(pred, 4) AS prediction FROM scored WHERE split = 'test'
""")
def lr_two_features(spark, d):
    """Least squares on two inputs; predictions of the held-out rows."""
    frame, model = _two_feature_fit(spark, d)
    scored = models.score(model, frame.filter("split = 'test'"))
    return scored.select(*ID, F.round("prediction", 4).alias("prediction"))


@query("lr_split_errors", "I1,J1,J2,J9,J10", f"""
WITH {_TWO_SQL.strip()}
SELECT split, count(*) AS n, round(avg((y - pred) ** 2), 7) AS mse,
       round(sqrt(avg((y - pred) ** 2)), 7) AS rmse
FROM scored GROUP BY split
""")
def lr_split_errors(spark, d):
    """Training and held-out errors of the two-input fit."""
    frame, model = _two_feature_fit(spark, d)
    err = F.col("label") - F.col("prediction")
    return models.score(model, frame).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(err * err), 7).alias("mse"),
        F.round(F.sqrt(F.avg(err * err)), 7).alias("rmse"))


@query("run_report", "A6,J1,J2", f"""
WITH {_TWO_SQL.strip()},
e AS (SELECT count(*)::DOUBLE AS n, avg((y - pred) ** 2) AS mse FROM scored WHERE split = 'test')
SELECT 'two-features' AS run_id, 'rows' AS name, n AS value FROM e
UNION ALL SELECT 'two-features', 'mse', round(mse, 7) FROM e
UNION ALL SELECT 'two-features', 'rmse', round(sqrt(mse), 7) FROM e
""")
def run_report_q(spark, d):
    """The two-input fit's report on the held-out rows, appended to a report
    table in the shared folder and read back."""
    frame, model = _two_feature_fit(spark, d)
    err = F.col("label") - F.col("prediction")
    r = models.score(model, frame.filter("split = 'test'")).agg(F.count(F.lit(1)), F.avg(err * err)).first()
    path = shared_folder(spark, "report")
    write_report(run_report(spark, {"rows": r[0], "mse": r[1], "rmse": r[1] ** 0.5 if r[0] else None}, "two-features"), path)
    return spark.read.schema("run_id string, name string, value string").parquet(path).select(
        "run_id", "name", F.round(F.col("value").try_cast("double"), 7).alias("value"))


@query("model_roundtrip", "I19", f"""
WITH {_TWO_SQL.strip()}
SELECT l_orderkey, l_linenumber, round(pred, 4) AS prediction, TRUE AS equal_to_fitted
FROM scored WHERE split = 'test'
""")
def model_roundtrip(spark, d):
    """Fit, save to the shared checkpoint folder, load back, and score with
    both: the loaded model's predictions, and whether they equal the fitted one's."""
    frame, model = _two_feature_fit(spark, d)
    path = shared_folder(spark, "model")
    models.save_model(model, path)
    loaded = models.load_pipeline_model(path)
    model.stages[-1].setPredictionCol("fitted")
    both = loaded.transform(model.transform(frame.filter("split = 'test'")))
    return both.select(*ID, F.round("prediction", 4).alias("prediction"),
                       (F.col("prediction") == F.col("fitted")).alias("equal_to_fitted"))


@query("tree_stump", "I2,I8", f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice / 1000.0 AS y,
                   {_DRAW} < 0.8 AS is_train FROM lineitem),
v AS (SELECT x, count(*) AS n, sum(y) AS s FROM li WHERE is_train GROUP BY x),
c AS (SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
      FROM v WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
best AS (SELECT x AS cut, sl / nl AS lo, (st - sl) / (nt - nl) AS hi FROM c WHERE nl < nt
         ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, round(CASE WHEN x <= cut THEN lo ELSE hi END, 4) AS prediction
FROM li, best WHERE NOT is_train
""")
def tree_stump(spark, d):
    """A tree of one split on the quantity; predictions of the held-out rows.

    64 bins hold every one of the 50 quantities, so all cuts are tried."""
    frame = features.assemble(_lines(spark, d), ["l_quantity"])
    model = DecisionTreeRegressor(maxDepth=1, maxBins=64, seed=SEED).fit(
        frame.filter("split = 'train'").select("features", "label"))
    return models.score(model, frame.filter("split = 'test'")).select(
        *ID, F.round("prediction", 4).alias("prediction"))


_STEPS = ((10.0, 5.0), (5.0, 2.0), (2.0, 1.0))


def _boundaries(frame):
    """Boundaries of both inputs at every step, from one scan for the extremes."""
    ends = frame.agg(F.min("l_quantity").alias("a"), F.max("l_quantity").alias("b"),
                     F.min("disc_pct").alias("c"), F.max("disc_pct").alias("e")).first()
    return [(features.boundaries_between(ends.a, ends.b, q), features.boundaries_between(ends.c, ends.e, s))
            for q, s in _STEPS]


def _cell_sql(q: float, s: float) -> str:
    def bucket(x, lo, hi, step):
        n = f"ceil((trunc({hi}) - trunc({lo})) / {step})"
        return (f"CASE WHEN {x} < trunc({lo}) THEN 0 ELSE "
                f"least(floor(({x} - trunc({lo})) / {step}) + 1, {n}) END")
    return (f"SELECT {q} AS qty_step, {s} AS disc_step, y, split, {bucket('x', 'xa', 'xb', q)} AS qc, "
            f"{bucket('z', 'za', 'zb', s)} AS dc FROM li, ends")


@query("resolution_sweep", "I17,E6,E7,E8,E9", f"""
WITH {_TWO_SQL.strip()},
ends AS (SELECT min(x) AS xa, max(x) AS xb, min(z) AS za, max(z) AS zb FROM li),
cells AS ({' UNION ALL '.join(_cell_sql(q, s) for q, s in _STEPS)}),
means AS (SELECT qty_step, disc_step, qc, dc, avg(y) AS pred FROM cells WHERE split = 'train' GROUP BY ALL),
base AS (SELECT avg(y) AS mean_y FROM li WHERE split = 'train'),
err AS (SELECT qty_step, disc_step, split, (y - coalesce(pred, mean_y)) ** 2 AS e
        FROM cells LEFT JOIN means USING (qty_step, disc_step, qc, dc), base)
SELECT qty_step::DOUBLE AS qty_step, disc_step::DOUBLE AS disc_step,
       round(sqrt(avg(e) FILTER (split = 'train')), 7) AS train_rmse,
       round(sqrt(avg(e) FILTER (split = 'test')), 7) AS test_rmse
FROM err GROUP BY qty_step, disc_step
""")
def resolution_sweep(spark, d):
    """Crossed-indicator model at several bucket resolutions, all from one
    scan and one grouped aggregate."""
    frame = _lines(spark, d)
    grids = []
    for (q, s), (qb, db) in zip(_STEPS, _boundaries(frame)):
        cell = features.cross_cell(features.bucket_index("l_quantity", qb),
                                   features.bucket_index("disc_pct", db), len(db) + 1)
        grids.append(F.struct(F.lit(q).alias("qty_step"), F.lit(s).alias("disc_step"), cell.alias("cell")))
    long = frame.select("label", "split", F.explode(F.array(*grids)).alias("g")).select("label", "split", "g.*")
    out = models.cell_mean_errors(long, ["qty_step", "disc_step"], "cell", "label", F.col("split") == "train")
    return out.select("qty_step", "disc_step", F.round("train_rmse", 7).alias("train_rmse"),
                      F.round("test_rmse", 7).alias("test_rmse"))
