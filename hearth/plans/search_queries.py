"""The linear part of the search (I1, I5-I7) with its SQL: coordinate descent is
a fixed number of steps on sums, so SQL can take the same steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.scalar import log1p, mix_unit, mix_unit_sql
from hearth.operators import features, models, search
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 7
FOLDS = 5
_X = ("x0", "x1", "x2", "x3", "x4")
_ALL = (*_X, "y")
_P = len(_X)


def search_frame(spark, d):
    """Line items with their parts' attributes as numbers, the logarithm of the
    price, and a fold drawn from the order."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    j = l.join(p, l.l_partkey == p.p_partkey)
    for col, code in (("p_brand", "brand_code"), ("p_type", "type_code")):
        j = features.apply_level_codes(j, features.level_codes(j, col, code), col)
    return j.select(F.col("l_quantity").cast("double").alias("x0"), F.col("l_discount").cast("double").alias("x1"),
                    F.col("p_size").cast("double").alias("x2"), F.col("brand_code").cast("double").alias("x3"),
                    F.col("type_code").cast("double").alias("x4"), log1p("l_extendedprice").alias("y"),
                    F.floor(mix_unit("l_orderkey", SEED) * FOLDS).cast("int").alias("fold"))


def _code_sql(col: str) -> str:
    return (f"(SELECT {col}, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS code "
            f"FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY {col})")


_COV = "[" + ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in _ALL) + "]" for a in _ALL) + "]"
_MEAN = "[" + ", ".join(f"avg({a})" for a in _ALL) + "]"
_MAX = max(models.GRID_LR_MAX_ITER)


def _values(xs) -> str:
    return ", ".join(f"({x})" for x in xs)


# a step updates one coefficient: j = step % P. c has covariances, s standard deviations.
_SEARCH_SQL = f"""
WITH RECURSIVE
fr AS (SELECT l_quantity::DOUBLE AS x0, l_discount::DOUBLE AS x1, p_size::DOUBLE AS x2, b.code::DOUBLE AS x3,
              t.code::DOUBLE AS x4, ln(1 + l_extendedprice) AS y,
              floor({mix_unit_sql("l_orderkey", SEED)} * {FOLDS})::INTEGER AS fold
       FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN {_code_sql("p_brand")} b ON part.p_brand = b.p_brand
       JOIN {_code_sql("p_type")} t ON part.p_type = t.p_type),
folds AS (SELECT DISTINCT fold AS k FROM fr),
train AS (SELECT k, {_COV} AS c, {_MEAN} AS m FROM fr JOIN folds ON fold <> k GROUP BY k),
held AS (SELECT fold AS k, {_COV} AS c, {_MEAN} AS m FROM fr GROUP BY fold),
scaled AS (SELECT *, list_transform(range({_P + 1}), lambda i: sqrt(c[i + 1][i + 1])) AS s FROM train),
problem AS (SELECT k, m, s, reg, mix, reg * mix / s[{_P + 1}] AS l1, reg * (1 - mix) / s[{_P + 1}] AS l2,
                   list_transform(range({_P + 1}), lambda i: list_transform(range({_P + 1}),
                     lambda j: c[i + 1][j + 1] / (s[i + 1] * s[j + 1]))) AS a
            FROM scaled, (VALUES {_values(models.GRID_LR_REG_PARAM)}) r(reg),
                 (VALUES {_values(models.GRID_LR_ELASTIC_NET)}) e(mix)),
cd AS (SELECT k, reg, mix, 0 AS step, list_transform(range({_P}), lambda i: 0.0::DOUBLE) AS g FROM problem
       UNION ALL
       SELECT k, reg, mix, step + 1, list_transform(range({_P}), lambda i: CASE WHEN i = j
                THEN sign(rest) * greatest(abs(rest) - l1, 0) / (ajj + l2) ELSE g[i + 1] END)
       FROM (SELECT cd.*, p.l1, p.l2, step % {_P} AS j, p.a[step % {_P} + 1][step % {_P} + 1] AS ajj,
                    p.a[step % {_P} + 1][{_P + 1}] + p.a[step % {_P} + 1][step % {_P} + 1] * g[step % {_P} + 1]
                    - list_sum(list_transform(range({_P}), lambda i: p.a[step % {_P} + 1][i + 1] * g[i + 1])) AS rest
             FROM cd JOIN problem p USING (k, reg, mix) WHERE step < {_MAX * _P})),
fit AS (SELECT k, reg, mix, step // {_P} AS sweeps,
               list_transform(range({_P}), lambda i: g[i + 1] * s[{_P + 1}] / s[i + 1]) AS b, m
        FROM cd JOIN problem USING (k, reg, mix)
        WHERE step IN ({", ".join(str(i * _P) for i in models.GRID_LR_MAX_ITER)})),
err AS (SELECT reg, mix, sweeps, sqrt(
          (h.m[{_P + 1}] - f.m[{_P + 1}] - list_sum(list_transform(range({_P}), lambda i: (h.m[i + 1] - f.m[i + 1]) * b[i + 1]))) ** 2
          + h.c[{_P + 1}][{_P + 1}] - 2 * list_sum(list_transform(range({_P}), lambda i: h.c[i + 1][{_P + 1}] * b[i + 1]))
          + list_sum(list_transform(range({_P * _P}), lambda q: b[q // {_P} + 1] * h.c[q // {_P} + 1][q % {_P} + 1] * b[q % {_P} + 1]))
        ) AS rmse FROM fit f JOIN held h USING (k))
SELECT sweeps::INTEGER AS max_iter, reg::DOUBLE AS reg_param, mix::DOUBLE AS elastic_net_param,
       round(avg(rmse), 8) AS avg_metric, round(stddev_pop(rmse), 8) AS std_metric
FROM err GROUP BY sweeps, reg, mix
"""


@query("linear_search", "I1,I5,I6,I7,H3", _SEARCH_SQL)
def linear_search(spark, d):
    """The 63 elastic-net maps of the search over 5 folds, all from the folds'
    co-moments: one scan, no fit reads the data again."""
    moments = search.fold_moments(search_frame(spark, d), list(_ALL), "fold")
    maps = [{"maxIter": i, "regParam": r, "elasticNetParam": e} for i in models.GRID_LR_MAX_ITER
            for r in models.GRID_LR_REG_PARAM for e in models.GRID_LR_ELASTIC_NET]
    scores = search.linear_scores(moments, maps)
    rows = [(m["maxIter"], m["regParam"], m["elasticNetParam"], float(s.mean()), float(s.std()))
            for m, s in zip(maps, scores)]
    out = spark.createDataFrame(rows, "max_iter int, reg_param double, elastic_net_param double, "
                                      "avg_metric double, std_metric double")
    return out.withColumns({c: F.round(c, 8) for c in ("avg_metric", "std_metric")})
