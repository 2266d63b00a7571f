"""Logistic regression by Newton steps (I11, I15) with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators.logistic import fit_logistic_newton
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 7
STEPS = 7


def _frame(spark, d):
    """Every document: logarithm of its length, lines per hundred characters, and
    its quality where labelled."""
    text = F.coalesce("text", F.lit(""))
    chars = F.length(text).cast("double")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    docs = table(spark, d, "documents").select("doc_id", F.log1p(chars).alias("x1"), (100 * lines / (chars + 1)).alias("x2"))
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")


def _fit(spark, d):
    frame = _frame(spark, d)
    return frame, fit_logistic_newton(frame.filter(mix_unit("doc_id", SEED) < 0.8), ["x1", "x2"], "quality", STEPS)


# one row a step: the sums at b0, b1, b2, then Cramer's rule
_SUMS = ", ".join(["count(*) AS n", "sum(greatest(z, 0) - y * z + ln(1 + exp(-abs(z)))) AS loss"]
                  + [f"sum({x} * (y - p)) AS g{k}" for k, x in enumerate(("1", "x1", "x2"))]
                  + [f"sum({a} * {b} * p * (1 - p)) AS h{i}{j}" for i, a in enumerate(("1", "x1", "x2"))
                     for j, b in enumerate(("1", "x1", "x2")) if j >= i])


def _det(cols) -> str:
    (a, b, c), (d, e, f), (g, h, i) = zip(*cols)
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_H = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
_G = ["g0", "g1", "g2"]
_NEXT = ", ".join(f"b{k} + {_det([_G if j == k else _H[j] for j in range(3)])} / {_det(_H)} AS b{k}" for k in range(3))

_NEWTON_SQL = f"""
WITH RECURSIVE
fr AS (SELECT d.doc_id, ln(1 + length(coalesce(text, ''))) AS x1,
              100.0::DOUBLE * (length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1)
              / (length(coalesce(text, '')) + 1) AS x2, quality::DOUBLE AS y
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
tr AS (SELECT x1, x2, y FROM fr WHERE y IS NOT NULL AND {mix_unit_sql("doc_id", SEED)} < 0.8),
st AS (SELECT 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
       UNION ALL
       SELECT step + 1, {_NEXT}
       FROM (SELECT step, b0, b1, b2, {_SUMS}
             FROM (SELECT *, b0 + b1 * x1 + b2 * x2 AS z, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM st, tr)
             WHERE step < {STEPS} GROUP BY step, b0, b1, b2)),
hist AS (SELECT step, b0, b1, b2, {_SUMS}
       FROM (SELECT *, b0 + b1 * x1 + b2 * x2 AS z, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM st, tr)
       GROUP BY step, b0, b1, b2)"""


@query("logistic_newton", "I11", f"""{_NEWTON_SQL}
SELECT doc_id, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 6) AS p_quality FROM fr, st WHERE step = {STEPS}
""")
def logistic_newton(spark, d):
    """Quality probability of every document from two measures of its text."""
    frame, fit = _fit(spark, d)
    return frame.select("doc_id", F.round(fit.probability(["x1", "x2"]), 6).alias("p_quality"))


@query("newton_history", "I11,I15", f"""{_NEWTON_SQL}
SELECT step, round(loss / n, 9) AS log_loss, round(greatest(abs(g0), abs(g1), abs(g2)) / n, 7) AS gradient FROM hist
""")
def newton_history(spark, d):
    """Mean log loss and largest mean gradient at every step of the same fit."""
    _, fit = _fit(spark, d)
    return fit.history_frame(spark).select("step", F.round("log_loss", 9).alias("log_loss"),
                                           F.round("gradient", 7).alias("gradient"))
