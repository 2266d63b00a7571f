"""Data-parallel multilayer perceptron regression.

Spark ML has no MLP regressor, so this is a small custom estimator:

* rows stay on the executors as ``(row_id, x array<double>, y double)``,
  persisted once;
* each epoch ships the current weights (a few hundred to a few thousand
  numbers) to the tasks; ``mapInPandas`` runs forward and backward passes
  on Arrow batches and emits the partition's gradient as (k, g) rows;
* ``groupBy(k).sum`` reduces the gradients across partitions (a bounded
  K-row result) and Adam updates the weights on the driver.

Full-batch gradients make the result independent of the partitioning. With
``batch_size`` each partition takes its own mini-batch steps within an epoch
and the weights are averaged over the partitions, by rows, at its end: still
one job per epoch, whatever the row count. Rows are then dealt to partitions
whose number follows from the row count, so the result does not depend on the
cluster. (Steps that all tasks take together, through a barrier stage's
``allGather``, were tried: Spark answers one in about a second.)
Dropout masks come from a hash of (row id, epoch, unit), so a retried task
draws the same mask. L2 is added on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hearth.operators.models import spread_for_fit
from hearth.session import ship_package


def _shapes(n_in: int, hidden: Sequence[int]) -> list[tuple[int, int]]:
    dims = [n_in, *hidden, 1]
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def _unpack(theta: np.ndarray, shapes):
    out, pos = [], 0
    for a, b in shapes:
        w = theta[pos:pos + a * b].reshape(a, b)
        pos += a * b
        bias = theta[pos:pos + b]
        pos += b
        out.append((w, bias))
    return out


def _uniform_hash(ids: np.ndarray, epoch: int, width: int, seed: int) -> np.ndarray:
    """splitmix64 of (row id, epoch, unit) -> uniform [0, 1) matrix."""
    with np.errstate(over="ignore"):
        base = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        z = base + np.arange(width, dtype=np.uint64)[None, :] * np.uint64(0xBF58476D1CE4E5B9)
        z = z + np.uint64((epoch * 1000003 + seed) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _forward_backward(x, y, ids, params, dropout, epoch, seed, want_grad=True):
    acts, masks = [x], []
    h = x
    for li, (w, b) in enumerate(params):
        z = h @ w + b
        if li < len(params) - 1:
            h = np.maximum(z, 0.0)
            if dropout > 0 and want_grad:
                keep = _uniform_hash(ids, epoch, h.shape[1], seed + li) >= dropout
                m = keep / (1.0 - dropout)
                h = h * m
                masks.append(m)
            else:
                masks.append(None)
            acts.append(h)
        else:
            h = z
    pred = h[:, 0]
    err = pred - y
    if not want_grad:
        return pred, float(err @ err), None
    grads = []
    delta = (2.0 * err)[:, None]
    for li in range(len(params) - 1, -1, -1):
        w, _ = params[li]
        a = acts[li]
        grads.append((a.T @ delta, delta.sum(axis=0)))
        if li > 0:
            delta = delta @ w.T
            delta = delta * (acts[li] > 0)
            if masks[li - 1] is not None:
                delta = delta * (masks[li - 1] > 0) / (1.0 - dropout)
    grads.reverse()
    flat = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])
    return pred, float(err @ err), flat


@dataclass
class MLPRegressionModel:
    hidden: tuple[int, ...]
    theta: np.ndarray
    n_in: int
    history: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str = "x", out: str = "prediction") -> DataFrame:
        ship_package(df.sparkSession)
        shapes = _shapes(self.n_in, self.hidden)
        theta = self.theta

        def run(batches):
            params = _unpack(theta, shapes)
            for pdf in batches:
                if pdf.empty:
                    continue
                x = np.stack(pdf[features].to_numpy()).astype(np.float64)
                pred, _, _ = _forward_backward(x, np.zeros(len(pdf)), None, params, 0.0, 0, 0,
                                               want_grad=False)
                yield pdf.assign(**{out: pred})

        schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
        return df.mapInPandas(run, schema)


def fit_mlp(df: DataFrame, *, features: str = "x", label: str = "y", id_col: str = "row_id",
            hidden: Sequence[int] = (20, 12), epochs: int = 20, learning_rate: float = 0.01,
            l2: float = 0.0, l1: float = 0.0, dropout: float = 0.0,
            batch_size: int | None = None, partitions: int | None = None,
            seed: int = 7) -> MLPRegressionModel:
    """Fit relu hidden layers + linear output with squared loss and Adam
    (I12); ``l2`` / ``l1`` penalise hidden kernels (sum of squares / of
    absolute values), ``dropout`` masks hidden units (I13). ``history``
    holds the training MSE per epoch (I15).

    ``batch_size`` = None takes one full-batch step per epoch. Otherwise
    every one of the ``partitions`` takes a step per ``batch_size`` rows, in
    an order redrawn each epoch by a hash of (row id, epoch), and the epoch
    ends with the mean of their weights. The number of ``partitions`` follows
    from the number of rows if not given (:func:`models.fit_partitions`), so the
    result doesn't depend on the cluster. The output
    bias starts at the mean label. Rows without features or label are left
    out; a frame with no others raises ``ValueError``."""
    ship_package(df.sparkSession)
    data = df.select(id_col, features, label).where(F.col(features).isNotNull() & F.col(label).isNotNull())
    if batch_size:
        data = spread_for_fit(data, [id_col], partitions)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    first = data.agg(F.max(F.size(features)).alias("d"), F.avg(label).alias("m")).first()
    if first["d"] is None:
        data.unpersist()
        raise ValueError("empty training frame")
    n_in = int(first["d"])
    shapes = _shapes(n_in, hidden)
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in shapes:
        lim = np.sqrt(6.0 / (a + b))
        parts.append(rng.uniform(-lim, lim, size=a * b))
        parts.append(np.zeros(b))
    parts[-1] = np.array([float(first["m"])])
    theta = np.concatenate(parts)
    k_total = theta.size
    m = np.zeros(k_total)
    v = np.zeros(k_total)
    b1, b2, eps = 0.9, 0.999, 1e-7
    history = []
    hidden_mask = np.zeros(k_total, dtype=bool)
    pos = 0
    for li, (a, b) in enumerate(shapes):
        if li < len(shapes) - 1:
            hidden_mask[pos:pos + a * b] = True
        pos += a * b + b

    def penalised(grad: np.ndarray, cur: np.ndarray) -> np.ndarray:
        if l2:
            grad = grad + 2.0 * l2 * np.where(hidden_mask, cur, 0.0)
        if l1:
            grad = grad + l1 * np.where(hidden_mask, np.sign(cur), 0.0)
        return grad

    def adam(cur, m, v, grad, step):
        m = b1 * m + (1 - b1) * grad
        v = b2 * v + (1 - b2) * grad * grad
        move = learning_rate * (m / (1 - b1 ** step)) / (np.sqrt(v / (1 - b2 ** step)) + eps)
        return cur - move, m, v

    def arrays(pdf):
        return (np.stack(pdf[features].to_numpy()).astype(np.float64),
                pdf[label].to_numpy(dtype=np.float64), pdf[id_col].to_numpy())

    def reduced(part_fn, size: int):
        """Sums over partitions of the vectors ``part_fn`` gives, then squared
        error, row count and steps: one Spark job, ``groupBy(k)`` over ``size`` rows."""
        vec, tail = np.zeros(size), [0.0, 0.0, 0.0]
        for r in (data.mapInPandas(part_fn, "k int, g double").groupBy("k")
                      .agg(F.sum("g").alias("g"), F.max("g").alias("top")).collect()):
            if r["k"] >= 0:
                vec[r["k"]] = r["g"]
            else:
                tail[-1 - r["k"]] = r["top"] if r["k"] == -3 else r["g"]
        return vec, tail

    def emitted(vec, sse, n, steps):
        keys = np.concatenate([np.arange(vec.size), [-1, -2, -3]]).astype("int32")
        return pd.DataFrame({"k": keys, "g": np.concatenate([vec, [sse, float(n), float(steps)]])})

    def full_step(cur: np.ndarray, epoch: int):
        def run(batches):
            params = _unpack(cur, shapes)
            g, sse, n = np.zeros(k_total), 0.0, 0
            for pdf in batches:
                if len(pdf):
                    x, y, ids = arrays(pdf)
                    _, s, gr = _forward_backward(x, y, ids, params, dropout, epoch, seed)
                    g, sse, n = g + gr, sse + s, n + len(pdf)
            yield emitted(g, sse, n, 1)
        return run

    def local_steps(cur: np.ndarray, m0: np.ndarray, v0: np.ndarray, done: int, epoch: int):
        def run(batches):
            th, m, v = cur, m0, v0
            sse, n, steps = 0.0, 0, 0
            for pdf in batches:            # an Arrow batch at a time: bounded memory
                if not len(pdf):
                    continue
                x, y, ids = arrays(pdf)
                order = np.argsort(_uniform_hash(ids, epoch, 1, seed)[:, 0], kind="stable")
                for at in range(0, len(order), batch_size):
                    pick = order[at:at + batch_size]
                    _, s, g = _forward_backward(x[pick], y[pick], ids[pick], _unpack(th, shapes),
                                                dropout, epoch, seed)
                    steps += 1
                    th, m, v = adam(th, m, v, penalised(g / len(pick), th), done + steps)
                    sse += s
                    n += len(pick)
            yield emitted(np.concatenate([th, m, v]) * n, sse, n, steps)
        return run

    step = 0
    for epoch in range(1, epochs + 1):
        if batch_size:
            vec, (sse, n, steps) = reduced(local_steps(theta, m, v, step, epoch), 3 * k_total)
            theta, m, v = (vec[i * k_total:(i + 1) * k_total] / n for i in range(3))
            step += int(steps)
        else:
            vec, (sse, n, _) = reduced(full_step(theta, epoch), k_total)
            step += 1
            theta, m, v = adam(theta, m, v, penalised(vec / n, theta), step)
        history.append(sse / n)
    data.unpersist()
    return MLPRegressionModel(tuple(hidden), theta, n_in, history)


def topology_leaderboard(train: DataFrame, test: DataFrame, topologies: Sequence[Sequence[int]],
                         **fit_args) -> list[tuple[str, float, float]]:
    """Compare layer/unit counts by train and test MSE."""
    label = fit_args.get("label", "y")
    rows = []
    for hidden in topologies:
        model = fit_mlp(train, hidden=hidden, **fit_args)
        # both errors at the final weights; the last training loss is from before the last step
        tr, te = (model.transform(x).agg(F.avg(F.pow(F.col("prediction") - F.col(label), 2))).first()[0]
                  for x in (train, test))
        rows.append(("-".join(map(str, hidden)), float(tr), float(te)))
    return rows
