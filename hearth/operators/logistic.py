"""Logistic regression by Newton's method (I11): iteratively reweighted least
squares, where each step is one distributed weighted Gram matrix.

A step reads the rows once and brings back (inputs + 1)^2 / 2 sums: the
gradient, the Hessian and the loss at the present coefficients. Newton's steps
square the error, so about eight replace the hundreds of epochs of a gradient
learner, and every step's gradient is reported, so an optimum can be told.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: up to so many inputs the sums are aggregate expressions; beyond, matrix products in tasks
EXPRESSION_INPUTS = 20


class LogisticFit(NamedTuple):
    """Coefficients (the intercept first) and, for each step, the mean log loss and
    the largest absolute mean gradient before it; the last entry is the result's."""

    coefficients: list[float]
    history: list[tuple[float, float]]
    rows: int

    def probability(self, cols: Sequence[str]) -> Column:
        return _sigmoid(_score(self.coefficients, [F.col(f"`{c}`").cast("double") for c in cols]))

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """(step, log_loss, gradient)."""
        return spark.createDataFrame([(k, *h) for k, h in enumerate(self.history)],
                                     "step int, log_loss double, gradient double")


def _score(beta: Sequence[float], x: Sequence[Column]) -> Column:
    return sum((F.lit(float(b)) * c for b, c in zip(beta[1:], x)), F.lit(float(beta[0])))


def _sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def _expression_sums(rows: DataFrame, beta: np.ndarray, p: int):
    x = [F.lit(1.0), *[F.col("x")[i] for i in range(p)]]
    z = _score(beta, x[1:])
    scored = rows.select("x", "y", z.alias("z"), _sigmoid(z).alias("p"))
    rest, w, y = F.col("y") - F.col("p"), F.col("p") * (1 - F.col("p")), F.col("y")
    # log(1 + e^z) - yz, without overflow
    loss = F.greatest(F.col("z"), F.lit(0.0)) - y * F.col("z") + F.log1p(F.exp(-F.abs("z")))
    r = scored.agg(F.count("y"), F.sum(loss), *[F.sum(c * rest) for c in x],
                   *[F.sum(a * b * w) for i, a in enumerate(x) for b in x[:i + 1]]).first()
    gradient = np.array(r[2:3 + p], dtype=float)
    hessian = np.zeros((p + 1, p + 1))
    hessian[np.tril_indices(p + 1)] = r[3 + p:]
    return r[0], r[1], gradient, hessian + np.tril(hessian, -1).T


def _task_sums(beta: np.ndarray):
    def run(batches):
        total = np.zeros(1 + len(beta) + len(beta) ** 2 + 1)
        for batch in batches:
            n = batch.num_rows
            x = np.column_stack([np.ones(n), batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)])
            y = batch.column(1).to_numpy(zero_copy_only=False)
            z = x @ beta
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            loss = np.maximum(z, 0) - y * z + np.log1p(np.exp(-np.abs(z)))
            total += np.concatenate([[n, loss.sum()], x.T @ (y - p), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["k", "v"])
    return run


def _matrix_sums(rows: DataFrame, beta: np.ndarray, p: int):
    sums = rows.select("x", "y").mapInArrow(_task_sums(beta), "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    v = np.array([r.v for r in sums.orderBy("k").collect()])
    return int(v[0]), v[1], v[2:3 + p], v[3 + p:].reshape(p + 1, p + 1)


def fit_logistic_newton(df: DataFrame, cols: Sequence[str], label: str, steps: int = 8, reg: float = 0.0) -> LogisticFit:
    """Logistic regression of a 0/1 label by a fixed number of Newton steps from zero.

    The objective is the mean log loss plus ``reg / 2`` times the sum of squared
    coefficients (the intercept is free). Rows with a null are left out. Where
    the Hessian is singular (equal inputs), the smallest solution is taken. An
    empty table gives zeros and an empty history. Separable classes have no
    finite optimum: the gradients of the history then keep falling and
    coefficients grow, unless ``reg`` is above 0.
    """
    p = len(cols)
    rows = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"),
                     F.col(f"`{label}`").cast("double").alias("y"))
    rows = rows.filter(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())).persist(StorageLevel.MEMORY_AND_DISK)
    sums = _expression_sums if p <= EXPRESSION_INPUTS else _matrix_sums
    beta, history, n = np.zeros(p + 1), [], 0
    penalty = np.diag([0.0] + [reg] * p)
    try:
        for step in range(steps + 1):
            n, loss, gradient, hessian = sums(rows, beta, p)
            if not n:
                break
            slope = gradient / n - penalty @ beta
            history.append((float(loss / n + 0.5 * beta @ penalty @ beta), float(np.abs(slope).max())))
            if step < steps:
                beta = beta + np.linalg.lstsq(hessian / n + penalty, slope, rcond=None)[0]
    finally:
        rows.unpersist()
    return LogisticFit([float(b) for b in beta], history, int(n))
