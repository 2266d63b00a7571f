"""Regression trees, forests and boosted trees with exact splits.

Spark ML cuts a feature into at most ``maxBins`` values, chosen from a sample.
Here every distinct value is a candidate. A level of all trees is one job: rows
are routed by the splits found so far (array lookups inside generated code, no
state is carried), and grouped to attribute-value-class tables: per (tree,
node, feature, value) the number, sum and sum of squares of the labels. Prefix
sums over the values give the gain of every cut. They are taken inside buckets
of values, on top of the buckets' totals, so no task holds all values of a
feature, and rows only move as partial sums of their group.

The driver holds the splits: at most ``2 ** max_depth`` per tree.
"""

from __future__ import annotations

import math
from typing import Callable, NamedTuple, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearth.functions.scalar import count_below, mix_number, mix_unit

#: buckets that the values of a feature are dealt into
BUCKETS = 32


class ExactTree(NamedTuple):
    """Nodes are numbered from 1, the children of n are 2n (value at most the
    threshold) and 2n + 1 (above, null or NaN). A leaf's feature is -1."""

    feature: list[int]
    threshold: list[float]
    prediction: list[float]

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1


def _grow(tree: ExactTree, depth: int) -> ExactTree:
    """Room for the nodes of one more level of splits."""
    more = 2 ** depth - len(tree.feature)
    return ExactTree(tree.feature + [-1] * more, tree.threshold + [0.0] * more,
                     tree.prediction + [math.nan] * (2 * more))


def node_of(tree: ExactTree, x: Column) -> Column:
    """The number of the node that a row with the feature array ``x`` ends in."""
    if all(f < 0 for f in tree.feature):
        return F.lit(1)
    feature, threshold = F.lit(tree.feature), F.lit(tree.threshold)

    def step(node, _):
        f = feature[node]
        return F.when(f < 0, node).otherwise(2 * node + F.when(F.get(x, f) <= threshold[node], 0).otherwise(1))
    return F.aggregate(F.sequence(F.lit(1), F.lit(tree.depth)), F.lit(1), step)


def predicted(tree: ExactTree, x: Column) -> Column:
    return F.lit(tree.prediction)[node_of(tree, x)]


def _features(cols: Sequence[str]) -> Column:
    values = [F.col(f"`{c}`").cast("double") for c in cols]
    return F.array(*[F.when(~F.isnan(v), v) for v in values])


def _bucket_cuts(rows: DataFrame, p: int, buckets: int) -> list[list[float]]:
    """Values between buckets of about equal size. They only balance the work:
    any cuts give the same splits, so approximate quantiles will do."""
    steps = [k / buckets for k in range(1, buckets)]
    r = rows.agg(*[F.percentile_approx(F.col("x")[i], F.lit(steps)).alias(f"q{i}") for i in range(p)]).first()
    return [sorted(set(r[i] or ())) for i in range(p)]


def _best_splits(members: DataFrame, cuts: list[list[float]], min_rows: int) -> DataFrame:
    """(tree, node, n, s, gain, feature, threshold, nl, sl): each node's totals and
    its best cut, from rows (tree, node, w, y, feature, value)."""
    y, w = F.col("y"), F.col("w")
    avc = (members.groupBy("tree", "node", "feature", "value")
           .agg(F.sum(w).alias("n"), F.sum(w * y).alias("s"), F.sum(w * y * y).alias("q")))
    bucket = F.lit(None).cast("int")
    for f, values in enumerate(cuts):
        bucket = F.when(F.col("feature") == f, count_below("value", values)).otherwise(bucket)
    # nulls go right: their bucket is behind all others
    avc = avc.withColumn("bucket", F.coalesce(bucket, F.lit(1 << 20))).persist(StorageLevel.MEMORY_AND_DISK)
    key = ["tree", "node", "feature"]
    along = Window.partitionBy(*key).orderBy("bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*key)
    totals = avc.groupBy(*key, "bucket").agg(F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.sum("q").alias("bq"),
                                             F.min("value").alias("low"))
    totals = totals.select(
        *key, "bucket", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("bs").over(before), F.lit(0.0)).alias("s0"), F.sum("bn").over(every).alias("nt"),
        F.sum("bs").over(every).alias("st"), F.sum("bq").over(every).alias("qt"),
        F.min("low").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("next_low"))
    inside = Window.partitionBy(*key, "bucket").orderBy("value")
    cut = avc.join(totals, [*key, "bucket"]).select(
        *key, "value", "nt", "st", "qt", (F.col("n0") + F.sum("n").over(inside)).alias("nl"),
        (F.col("s0") + F.sum("s").over(inside)).alias("sl"),
        F.coalesce(F.lead("value").over(inside), "next_low").alias("next"))
    nr, sr = F.col("nt") - F.col("nl"), F.col("st") - F.col("sl")
    fits = F.col("value").isNotNull() & F.col("next").isNotNull() & (F.col("nl") >= min_rows) & (nr >= min_rows)
    gain = F.try_divide(F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("st") * F.col("st") / F.col("nt"),
                        F.col("qt"))
    # rounded, so that equal cuts tie in any order of summation
    gain = F.round(F.when(fits, gain), 10)
    ranked = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"))
    best = F.struct("feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"), "nl", "sl", gain.alias("gain"))
    out = cut.groupBy("tree", "node").agg(F.max("nt").alias("n"), F.max_by("st", F.col("feature")).alias("s"),
                                          F.max_by(best, F.when(gain.isNotNull(), ranked)).alias("b"))
    out.avc = avc
    return out


def fit_exact_trees(df: DataFrame, cols: Sequence[str], label: str | Column, max_depth: int, *, n_trees: int = 1,
                    weights: Callable[[int], Column] | None = None, bag_key: Column | str | None = None,
                    features_per_node: int | None = None,
                    seed: int = 7, min_rows: int = 1, min_gain: float = 1e-9) -> list[ExactTree]:
    """Greedy least-squares trees over the numeric columns ``cols``.

    A node is split at the cut, halfway between neighbouring values, with the
    largest reduction of squared error; ties go to the earlier feature, then
    the smaller value. It stays a leaf at ``max_depth``, if the reduction is at
    most ``min_gain`` of its labels' sum of squares, or if a side would have
    less than ``min_rows`` rows (by weight). ``weights`` gives a tree's
    whole-number row weights; ``bag_key``, an integer key of the rows, gives each
    tree a bag instead (:func:`bag_weight`). ``features_per_node`` says how many
    features, drawn by hash, a node may use. Null and NaN values go to
    the right; rows with a null label are left out. Without rows there is one
    leaf without prediction (NaN).
    """
    p = len(cols)
    y = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = df.select(_features(cols).alias("x"), y.cast("double").alias("y"), *[
        (bag_draw(bag_key, t, seed) if bag_key is not None else weights(t) if weights else F.lit(1)).alias(f"w{t}")
        for t in range(n_trees)]).filter("y IS NOT NULL")
    if bag_key is not None:
        rows = rows.withColumns({f"w{t}": bag_weight(F.col(f"w{t}")) for t in range(n_trees)})
    rows = rows.select("x", "y", F.array(*[F.col(f"w{t}").cast("long") for t in range(n_trees)]).alias("ws"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    cuts = _bucket_cuts(rows, p, BUCKETS)
    trees = [ExactTree([-1], [0.0], [math.nan] * 2) for _ in range(n_trees)]
    try:
        for depth in range(max_depth):
            at = [F.struct(F.lit(t).alias("tree"), node_of(tree, F.col("x")).alias("node"), F.col("ws")[t].alias("w"))
                  for t, tree in enumerate(trees)]
            allowed = F.lit([[_allowed(t, node, p, features_per_node or p, seed)
                              for node in range(2 ** depth, 2 ** (depth + 1))] for t in range(n_trees)])
            mine = allowed[F.col("m.tree")][F.col("m.node") - 2 ** depth]
            members = (rows.select("x", "y", F.explode(F.array(*at)).alias("m"))
                       .filter(f"m.w > 0 AND m.node >= {2 ** depth}")
                       .select("m.*", "x", "y", F.explode(mine).alias("feature"))
                       .select("tree", "node", "w", "y", "feature", F.get("x", F.col("feature")).alias("value")))
            best = _best_splits(members, cuts, min_rows)
            found = best.collect()
            best.avc.unpersist()
            if not found:
                break
            trees = [_grow(t, depth + 1) for t in trees]
            for r in found:
                tree, node, b = trees[r["tree"]], r["node"], r["b"]
                tree.prediction[node] = r["s"] / r["n"]
                if b is not None and b["gain"] is not None and b["gain"] > min_gain:
                    tree.feature[node], tree.threshold[node] = b["feature"], b["threshold"]
                    tree.prediction[2 * node] = b["sl"] / b["nl"]
                    tree.prediction[2 * node + 1] = (r["s"] - b["sl"]) / (r["n"] - b["nl"])
    finally:
        rows.unpersist()
    return trees


def _allowed(tree: int, node: int, p: int, count: int, seed: int) -> list[int]:
    """The features a node may use: those with the ``count`` smallest draws."""
    return sorted(sorted(range(p), key=lambda f: mix_number((tree * 65536 + node) * 64 + f, seed))[:count])


#: P(at most k) of the Poisson distribution with mean 1
POISSON_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]).tolist()


def bag_draw(key: Column | str, tree: int, seed: int) -> Column:
    """A row's uniform draw for a tree, from a hash of its integer key (below 2^58)."""
    return mix_unit((F.col(key) if isinstance(key, str) else key) * 32 + tree, seed)


def bag_weight(draw: Column) -> Column:
    """How often a row with this draw is in a bag: Poisson with mean 1."""
    return count_below(draw, POISSON_CDF, inclusive=True)


def forest_prediction(trees: Sequence[ExactTree], cols: Sequence[str]) -> Column:
    """The mean of the trees' predictions."""
    total = sum((predicted(t, _features(cols)) for t in trees[1:]), predicted(trees[0], _features(cols)))
    return total / len(trees)


def boosted_prediction(trees: Sequence[ExactTree], cols: Sequence[str], step: float) -> Column:
    """The first tree's prediction and ``step`` times each other's (I4)."""
    x = _features(cols)
    return sum((step * predicted(t, x) for t in trees[1:]), predicted(trees[0], x))


def fit_exact_boosted(df: DataFrame, cols: Sequence[str], label: str, max_depth: int, iterations: int,
                      step: float = 0.1, **options) -> list[ExactTree]:
    """Gradient boosting with squared loss (I4): the first tree fits the label,
    each other one the negative gradient, twice the residual."""
    trees = fit_exact_trees(df, cols, label, max_depth, **options)
    for _ in range(iterations - 1):
        residual = 2 * (F.col(f"`{label}`") - boosted_prediction(trees, cols, step))
        trees += fit_exact_trees(df, cols, residual, max_depth, **options)
    return trees
