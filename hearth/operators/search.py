"""Cross-validated search with shared work.

A grid of P maps over k folds is P x k fits when every map is fitted on its
own. Here what maps have in common is computed once:

* **Linear maps.** The co-moments of features and label of every fold come from
  one scan. A fold's training moments are the other folds' together, elastic
  nets are solved on them by coordinate descent for all (regParam,
  elasticNetParam), each sweep serving one more ``maxIter``, and the held-out
  error is a quadratic form in the fold's own moments. Nothing is scored.
* **Trees.** A greedy tree of depth d is the upper part of the deeper one, so
  the deepest serves all depths.
* **Forests.** One forest of the most trees and the greatest depth serves all:
  its first n trees, cut at depth d.
* **Boosting.** A chain's first m trees are the model of ``maxIter`` m, so each
  depth is one chain.

The trees, forests and chains of all folds grow together, one pass over the
binned rows for a level of all (:mod:`hearth.operators.binned_trees`).
The grown trees of all folds (their number of nodes is bounded by the grid)
score the data together in one pass, that adds up squared errors of every map
per fold.
"""

from __future__ import annotations

import uuid
from multiprocessing.pool import ThreadPool
from typing import NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearth.operators import binned_trees
from hearth.operators.comoments import co_moments, merge
from hearth.session import checkpoint_dir


# ---------------------------------------------------------------- linear maps

class Moments(NamedTuple):
    """Rows, means and centred products of the columns; the label is the last."""

    n: float
    mean: np.ndarray
    c: np.ndarray


def fold_moments(df: DataFrame, cols: Sequence[str], fold: str) -> dict[int, Moments]:
    """The moments of ``cols`` in every fold, from one scan. The driver gets
    (number of columns)^2 numbers per fold. Rows with a null are not expected."""
    p = len(cols)
    out: dict[int, Moments] = {}
    for r in co_moments(df, cols, fold).collect():
        m = out.setdefault(r["key"], Moments(r["n"], np.zeros(p), np.zeros((p, p))))
        m.mean[r["x"]], m.mean[r["y"]] = r["mean_x"], r["mean_y"]
        m.c[r["x"], r["y"]] = m.c[r["y"], r["x"]] = r["c_xy"]
    return out


def pooled(parts: Sequence[Moments]) -> Moments:
    """The moments of several sets of rows together."""
    def wide(m: Moments):
        return [np.full(m.c.shape, float(m.n)), np.repeat(m.mean[:, None], len(m.mean), 1),
                np.repeat(m.mean[None, :], len(m.mean), 0), np.zeros(m.c.shape), np.zeros(m.c.shape), m.c]
    state = wide(parts[0])
    for m in parts[1:]:
        state = merge(state, wide(m))
    return Moments(state[0][0, 0], state[1][:, 0], state[5])


def elastic_net(m: Moments, reg: float, mix: float, sweeps: Sequence[int]) -> dict[int, tuple[np.ndarray, float]]:
    """{sweeps: (coefficients, intercept)} of the elastic net after so many
    sweeps of coordinate descent from zero.

    The objective is that of Spark ML's normal-equation solver: features and
    label are scaled to population standard deviation 1, where ``reg`` is divided by the label's; the penalty
    is ``mix`` times the sum of absolute values plus ``(1 - mix) / 2`` times the
    sum of squares. A constant feature gets coefficient 0.
    """
    p = len(m.mean) - 1
    sd = np.sqrt(np.diag(m.c) / m.n)
    scale = np.where(sd > 0, sd, 1.0)
    a = m.c / m.n / np.outer(scale, scale)
    l1, l2 = reg * mix / scale[p], reg * (1 - mix) / scale[p]
    g = np.zeros(p)
    out = {}
    for sweep in range(1, max(sweeps) + 1):
        for j in range(p):
            if sd[j] > 0 and sd[p] > 0:
                rest = a[j, p] - a[j, :p] @ g + a[j, j] * g[j]
                g[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (a[j, j] + l2)
        if sweep in sweeps:
            beta = g * scale[p] / scale[:p]
            out[sweep] = beta, float(m.mean[p] - m.mean[:p] @ beta)
    return out


def held_out_rmse(m: Moments, beta: np.ndarray, intercept: float) -> float:
    """Root of the mean squared error of a linear model over rows with these moments."""
    p = len(beta)
    bias = m.mean[p] - intercept - m.mean[:p] @ beta
    spread = m.c[p, p] - 2 * m.c[p, :p] @ beta + beta @ m.c[:p, :p] @ beta
    return float(np.sqrt(max(bias * bias + spread / m.n, 0.0)))


def linear_scores(moments: dict[int, Moments], maps: Sequence[dict]) -> np.ndarray:
    """RMSE of every map (``maxIter``, ``regParam``, ``elasticNetParam``) on every
    fold, fitted on the others."""
    folds = sorted(moments)
    out = np.full((len(maps), len(folds)), np.nan)
    nets = sorted({(m["regParam"], m["elasticNetParam"]) for m in maps})
    for k, fold in enumerate(folds):
        others = [moments[f] for f in folds if f != fold]
        if not others:
            continue
        train = pooled(others)
        for net in nets:
            mine = [i for i, m in enumerate(maps) if (m["regParam"], m["elasticNetParam"]) == net]
            fits = elastic_net(train, *net, sorted({maps[i]["maxIter"] for i in mine}))
            for i in mine:
                out[i, k] = held_out_rmse(moments[fold], *fits[maps[i]["maxIter"]])
    return out


# ---------------------------------------------------------------- trees

class Tree(NamedTuple):
    """A fitted tree as arrays by node number; 0 is the root, -1 no child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    categories: dict[int, np.ndarray]      # node: values that go left, of a categorical split

    def _category_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node's row in a table (-1: no categorical split), and the table:
        whether a category's code goes left."""
        nodes = np.full(len(self.left), -1)
        nodes[list(self.categories)] = np.arange(len(self.categories))
        width = 1 + max((int(v.max()) for v in self.categories.values() if len(v)), default=0)
        table = np.zeros((max(len(self.categories), 1), width), bool)
        for k, codes in enumerate(self.categories.values()):
            table[k, codes.astype(np.int64)] = True
        return nodes, table

    def by_depth(self, x: np.ndarray, depths: Sequence[int]) -> dict[int, np.ndarray]:
        """Predictions of the tree cut at each depth."""
        nodes, goes_left = self._category_table()
        own = np.arange(len(self.left))
        children = np.stack([np.where(self.left < 0, own, self.right), np.where(self.left < 0, own, self.left)], 1).ravel()
        node = np.zeros(len(x), np.int64)       # a row that has reached a leaf stays there
        values, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        out = {}
        for depth in range(max(depths) + 1):
            if depth in depths:
                out[depth] = self.prediction[node]
            if depth == max(depths):
                break
            value = values[first + self.feature[node]]
            go_left = value <= self.threshold[node]
            at = nodes[node]
            of_category = np.flatnonzero(at >= 0)
            if len(of_category):
                # a code that no split sends left is beyond the table or is no whole number
                code = value[of_category]
                whole = np.where((code >= 0) & (code < goes_left.shape[1]), code, 0).astype(np.int64)
                go_left[of_category] = goes_left[at[of_category], whole] & (whole == code)
            node = children[2 * node + go_left]
        return out


def tree_arrays(model) -> list[Tree]:
    """The trees of a fitted Spark ML tree, forest or boosted model, read from
    its persisted form (the nodes, whose number the model's depth bounds)."""
    spark = SparkSession.active()
    path = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    else:
        data = data.withColumn("treeID", F.lit(0))
    by_tree: dict[int, list] = {}
    for r in data.select("treeID", "id", "prediction", "leftChild", "rightChild", "split").collect():
        by_tree.setdefault(r["treeID"], []).append(r)
    fs.delete(hpath, True)
    out = []
    for number in sorted(by_tree):
        nodes = sorted(by_tree[number], key=lambda r: r["id"])
        place = {r["id"]: k for k, r in enumerate(nodes)}
        inner = [r["leftChild"] >= 0 for r in nodes]
        plain = [i and r["split"]["numCategories"] < 0 for i, r in zip(inner, nodes)]
        out.append(Tree(
            np.array([r["split"]["featureIndex"] if i else 0 for i, r in zip(inner, nodes)]),
            np.array([r["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for i, r in zip(plain, nodes)]),
            np.array([place[r["leftChild"]] if i else -1 for i, r in zip(inner, nodes)]),
            np.array([place[r["rightChild"]] if i else -1 for i, r in zip(inner, nodes)]),
            np.array([r["prediction"] for r in nodes]),
            {k: np.array(r["split"]["leftCategoriesOrThreshold"]) for k, (i, q, r) in enumerate(zip(inner, plain, nodes))
             if i and not q}))
    return out


class Ensemble(NamedTuple):
    """Trees whose first ones, cut at a depth, are models of several maps:
    ``maps`` has (map number, depth, number of trees)."""

    trees: list[Tree] | list[binned_trees.Grown]
    weights: list[float]
    mean: bool
    maps: list[tuple[int, int, int]]

    def predictions(self, x: np.ndarray):
        depths = sorted({d for _, d, _ in self.maps})
        sums = dict.fromkeys(depths, 0.0)
        for k, (tree, weight) in enumerate(zip(self.trees, self.weights), 1):
            for d, y in tree.by_depth(x, depths).items():
                sums[d] = sums[d] + weight * y
            for number, d, count in self.maps:
                if count == k:
                    yield number, sums[d] / k if self.mean else sums[d]


#: rows that are scored together, as every tree costs some steps per call
SCORED_ROWS = 50_000


def _errors(models: dict[int, list[Ensemble]]):
    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SCORED_ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches):
        total: dict[tuple[int, int], list[float]] = {}
        for batch in (b for block in blocks(batches) for b in block):
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1)
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(fold), -1)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                here = fold == f
                _add_errors(total, int(f), models.get(int(f), ()), x[here], y[here])
        yield from _error_rows(total)
    return run


_ERRORS = "map int, fold int, n long, sse double"


def _add_errors(total: dict, fold: int, ensembles, x: np.ndarray, y: np.ndarray) -> None:
    for ensemble in ensembles:
        for number, predicted in ensemble.predictions(x):
            add = total.setdefault((number, fold), [0, 0.0])
            add[0] += len(y)
            add[1] += float(np.square(predicted - y).sum())


def _error_rows(total: dict):
    if total:
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k][0] for k in keys], pa.int64()), pa.array([total[k][1] for k in keys], pa.float64())],
            ["map", "fold", "n", "sse"])


def _block_errors(models: dict[int, list[tuple[int, Ensemble]]], n_cuts: int, width: int):
    """As :func:`_errors`, over blocks: ``models`` by a fold's place, with the number of their cuts."""
    def run(batches):
        total: dict[tuple[int, int], list[float]] = {}
        for _, fold, y, bins in binned_trees.arrays(batches, n_cuts, width):
            for f in np.unique(fold):
                here = np.flatnonzero(fold == f)
                for number in sorted({n for n, _ in models.get(int(f), ())}):
                    _add_errors(total, int(f), [e for n, e in models[int(f)] if n == number],
                                bins[number].take(here, axis=1), y[here])
        yield from _error_rows(total)
    return run


def _summed_errors(rows: DataFrame) -> dict[tuple[int, int], float]:
    """{(map, fold): root mean squared error} of the rows of :func:`_errors`."""
    sums = rows.groupBy("map", "fold").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"))
    return {(r["map"], r["fold"]): np.sqrt(r["sse"] / r["n"]) for r in sums.collect()}


def _ensemble(kind: str, est, data: DataFrame, maps: list[tuple[int, dict]], seed_params: dict) -> Ensemble:
    model = est.copy({getattr(est, k): v for k, v in seed_params.items()}).fit(data)
    trees = tree_arrays(model)
    weights = list(model.treeWeights) if kind != "tree" else [1.0]
    if kind == "forest":
        weights = [1.0] * len(trees)
    return Ensemble(trees, weights, kind == "forest", _map_sizes(kind, maps))


#: parameters that decide what trees are fitted; those growing together have these values, or take any (None)
_GROWN = {"maxBins": None, "minInstancesPerNode": None, "minInfoGain": None, "maxMemoryInMB": None, "seed": None,
          "maxDepth": None, "maxIter": None, "numTrees": None, "stepSize": None, "impurity": ("variance",),
          "subsamplingRate": (1.0,), "minWeightFractionPerNode": (0.0,), "bootstrap": (True,), "lossType": ("squared",),
          "featureSubsetStrategy": ("auto", "all", "onethird"), "weightCol": (), "validationIndicatorCol": ()}


def _grows(kind: str, est) -> bool:
    """Whether an estimator's trees are grown with the others, or by Spark ML."""
    for name, values in _GROWN.items():
        if values is not None and est.hasParam(name) and est.isDefined(name) and est.getOrDefault(name) not in values:
            return False
    if kind == "boosted" and est.getOrDefault("featureSubsetStrategy") == "onethird":
        return False
    return True


def _fit(kind: str, est, params: dict, fold: int, number: int, cuts: binned_trees.Cuts) -> binned_trees.Fit:
    get = est.getOrDefault
    trees = {"tree": 1, "forest": params.get("numTrees"), "boosted": params.get("maxIter")}[kind]
    width = per_node = len(cuts.bins)
    if kind == "forest" and (get("featureSubsetStrategy") == "onethird" or get("featureSubsetStrategy") == "auto" and trees > 1):
        per_node = -(-width // 3)
    return binned_trees.Fit(kind, fold, params["maxDepth"], trees, get("seed"), number, cuts, get("minInstancesPerNode"),
                            get("minInfoGain"), get("stepSize") if kind == "boosted" else 1.0, per_node,
                            get("maxMemoryInMB") << 20)


def _row_counts(prepared: DataFrame, fold: str) -> tuple[dict[int, int], dict[int, int]]:
    """Rows by fold and by partition."""
    folds: dict[int, int] = {}
    partitions: dict[int, int] = {}
    for r in prepared.groupBy(F.spark_partition_id().alias("_p"), F.col(fold).alias("_f")).count().collect():
        folds[r["_f"]] = folds.get(r["_f"], 0) + r["count"]
        partitions[r["_p"]] = partitions.get(r["_p"], 0) + r["count"]
    return folds, partitions


def _ml_model(kind: str, est, grown: list, fit: binned_trees.Fit, spark: SparkSession):
    """Spark ML's model of grown trees: one of bare leaves is saved, and loaded with the trees' nodes."""
    sc = spark.sparkContext
    jvm, width = sc._jvm, len(fit.cuts.bins)
    leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(
        sc._gateway.new_array(jvm.double, 3), 0))
    single = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    if kind == "tree":
        bare = single(est.uid, leaf, width)
    else:
        trees = sc._gateway.new_array(single, len(grown))
        for k in range(len(grown)):
            trees[k] = single(f"{est.uid}_{k}", leaf, width)
        if kind == "forest":
            bare = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(est.uid, trees, width)
        else:
            weights = sc._gateway.new_array(jvm.double, len(grown))
            for k in range(len(grown)):
                weights[k] = 1.0 if k == 0 else fit.step
            bare = jvm.org.apache.spark.ml.regression.GBTRegressionModel(est.uid, trees, weights, width)
    model = est._copyValues(est._create_model(bare))
    path = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    try:
        model.write().overwrite().save(path)
        schema = spark.read.parquet(f"{path}/data").schema
        rows = [n if kind == "tree" else {"treeID": k, "nodeData": n} for k, g in enumerate(grown) for n in g.nodes()]
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/data")
        return type(model).load(path)
    finally:
        fs.delete(hpath, True)


def fit_map(prepared: DataFrame, kind: str, est, params: dict, *, fold: str = "fold", features: str = "features",
            label: str = "label"):
    """The Spark ML model of one map on all rows of ``prepared``; trees are grown as in the search."""
    own = est.copy({getattr(est, k): v for k, v in params.items()})
    if kind == "linear" or not _grows(kind, est):
        return own.fit(prepared)
    params = {"maxDepth": own.getOrDefault("maxDepth")} | {
        k: own.getOrDefault(k) for k in ("numTrees", "maxIter") if own.hasParam(k)}
    counts, partitions = _row_counts(prepared, fold)
    width = len(prepared.select(vector_to_array(features)).first()[0])
    cuts = binned_trees.find_cuts(prepared, features, sum(counts.values()), width, own.getOrDefault("maxBins"), own.getOrDefault("seed"))
    fit = _fit(kind, own, params, -1, 0, cuts)
    bags = fit.trees if kind == "forest" else 0
    data = binned_trees.blocks(prepared, [cuts], [], fold=fold, features=features, label=label, bags=bags, seed=fit.seed,
                               expected=partitions)
    try:
        grown, = binned_trees.grow(data, [fit], bags, 1)
    finally:
        data.unpersist()
    return _ml_model(kind, own, grown, fit, prepared.sparkSession)


def _map_sizes(kind: str, maps: list[tuple[int, dict]]) -> list[tuple[int, int, int]]:
    sizes = {"tree": lambda p: 1, "forest": lambda p: p["numTrees"], "boosted": lambda p: p["maxIter"]}[kind]
    return [(i, p["maxDepth"], sizes(p)) for i, p in maps]


def _grow_together(prepared: DataFrame, jobs: list, folds: list[int], fold: str, features: str, label: str,
                   parallelism: int) -> dict[tuple[int, int], float]:
    """The errors, by map and place of the fold, of all jobs (fold, kind, estimator,
    maps, parameters), whose trees grow together."""
    counts, partitions = _row_counts(prepared, fold)
    width = len(prepared.select(vector_to_array(features)).first()[0])

    def cut(key):
        held, max_bins, seed = key
        return key, binned_trees.find_cuts(prepared.filter(F.col(fold) != held), features, sum(counts.values()) - counts[held],
                                           width, max_bins, seed)

    def of(job):
        return job[0], job[2].getOrDefault("maxBins"), job[2].getOrDefault("seed")
    pool = ThreadPool(min(parallelism, len(jobs)))
    try:
        cuts = dict(pool.map(inheritable_thread_target(cut), sorted({of(j) for j in jobs})))
    finally:
        pool.close()
    unlike = list(dict.fromkeys(cuts.values()))
    fits = [_fit(kind, est, params, folds.index(f), unlike.index(cuts[of(job)]), cuts[of(job)])
            for job in jobs for f, kind, est, _, params in [job]]
    forests = [f for f in fits if f.kind == "forest"]
    data = binned_trees.blocks(prepared, unlike, folds, fold=fold, features=features, label=label,
                               bags=max((f.trees for f in forests), default=0), seed=forests[0].seed if forests else 0, expected=partitions)
    try:
        models: dict[int, list[tuple[int, Ensemble]]] = {}
        for job, fit, trees in zip(jobs, fits, binned_trees.grow(data, fits, max((f.trees for f in forests), default=0), len(unlike))):
            weights = [1.0 if job[1] != "boosted" or k == 0 else fit.step for k in range(len(trees))]
            models.setdefault(fit.fold, []).append((fit.cuts_number, Ensemble(
                [t.grown() for t in trees], weights, job[1] == "forest", _map_sizes(job[1], job[3]))))
        return _summed_errors(data.mapInArrow(_block_errors(models, len(unlike), width), _ERRORS))
    finally:
        data.unpersist()


def _shared_fits(kind: str, maps: list[tuple[int, dict]]) -> list[tuple[dict, list[tuple[int, dict]]]]:
    """(parameters of a fit, the maps it serves)."""
    if not maps:
        return []
    if kind == "boosted":
        out = []
        for depth in sorted({p["maxDepth"] for _, p in maps}):
            mine = [m for m in maps if m[1]["maxDepth"] == depth]
            out.append(({"maxDepth": depth, "maxIter": max(p["maxIter"] for _, p in mine)}, mine))
        return out
    largest = {k: max(p[k] for _, p in maps) for k in maps[0][1]}
    return [(largest, maps)]


_KINDS = {"LinearRegression": "linear", "DecisionTreeRegressor": "tree",
          "RandomForestRegressor": "forest", "GBTRegressor": "boosted"}


def parameter_maps(grid: Sequence[dict]) -> list[tuple[str, object, dict]]:
    """(kind, estimator, {parameter: value}) of every map of a grid over the
    ``stages`` of a pipeline with one estimator each."""
    out = []
    for pm in grid:
        est = next(v for p, v in pm.items() if p.name == "stages")[0]
        out.append((_KINDS[type(est).__name__], est, {p.name: v for p, v in pm.items() if p.name != "stages"}))
    return out


def linear_moments(prepared: DataFrame, features: str, label: str, fold: str) -> dict[int, Moments]:
    """Per-fold moments of an assembled feature vector's elements and the label."""
    first = prepared.select(vector_to_array(features).alias("x")).first()
    width = len(first["x"]) if first else 0
    flat = prepared.select(fold, vector_to_array(features).alias("_x"), F.col(label).alias("_y")).select(
        fold, *[F.col("_x")[i].alias(f"_x{i}") for i in range(width)], "_y")
    return fold_moments(flat, [f"_x{i}" for i in range(width)] + ["_y"], fold)


def shared_search(prepared: DataFrame, grid: Sequence[dict], *, fold: str = "fold", features: str = "features",
                  label: str = "label", parallelism: int = 3) -> np.ndarray:
    """RMSE of every map of ``grid`` on every fold, in the grid's order.

    ``prepared`` has assembled feature vectors without nulls, a label and an
    integer fold; keep it persisted, as every fit reads it. Needs two folds.
    """
    parsed = parameter_maps(grid)
    folds = sorted(r[0] for r in prepared.select(fold).distinct().collect())
    out = np.full((len(grid), len(folds)), np.nan)
    linear = [(i, p) for i, (kind, _, p) in enumerate(parsed) if kind == "linear"]
    if linear:
        scores = linear_scores(linear_moments(prepared, features, label, fold), [p for _, p in linear])
        out[[i for i, _ in linear]] = scores
    jobs = []
    for kind in ("boosted", "forest", "tree"):
        mine = [(i, p) for i, (k, _, p) in enumerate(parsed) if k == kind]
        est = next((e for k, e, _ in parsed if k == kind), None)
        for params, served in _shared_fits(kind, mine):
            jobs += [(f, kind, est, served, params) for f in folds]

    def fit(job):
        f, kind, est, served, params = job
        return f, _ensemble(kind, est, prepared.filter(F.col(fold) != f), served, params)
    together = [j for j in jobs if _grows(j[1], j[2])]
    if together:
        for (number, place), rmse in _grow_together(prepared, together, folds, fold, features, label, parallelism).items():
            out[number, place] = rmse
    alone = [j for j in jobs if j not in together]
    if alone:
        pool = ThreadPool(min(parallelism, len(alone)))
        try:
            models: dict[int, list[Ensemble]] = {f: [] for f in folds}
            for f, ensemble in pool.imap_unordered(inheritable_thread_target(fit), alone):
                models[f].append(ensemble)
        finally:
            pool.close()
        rows = (prepared.select(F.col(fold).cast("int"), vector_to_array(features).alias("x"),
                                F.col(label).cast("double").alias("y")).mapInArrow(_errors(models), _ERRORS))
        for (number, f), rmse in _summed_errors(rows).items():
            out[number, folds.index(f)] = rmse
    return out
