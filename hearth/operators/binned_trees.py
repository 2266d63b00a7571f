"""Many binned regression trees grown together: those of Spark ML, in numpy.

A search fits trees, forests and boosted chains on every fold. Spark ML grows
them one fit at a time, each over its own copy of the rows and with a pass per
level. Here the rows are cut into the bins of Spark ML once and kept as arrays,
a block of rows each, and one pass grows the next level of **all** trees of all
fits and folds. A task adds up (rows, sum, sum of squares) of every node,
feature and bin; these are reduced per tree, where the best splits are found,
so the driver gets a few numbers per node.

Candidate splits, gains, ties, the order in which nodes draw their features and
the bags (:mod:`hearth.operators.bags`) follow Spark ML's ``RandomForest`` and
``GradientBoostedTrees``; the trees are the same up to the order of sums.
"""

from __future__ import annotations

import pickle
from typing import Iterable, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from hearth.operators.bags import JavaRandom, PoissonStream, XorShift, drawn_features, map_order

_INVALID = -np.finfo(np.float64).max
_EPSILON = np.finfo(np.float64).eps
#: rows of a block
BLOCK_ROWS = 65_536
#: bytes of sums that a task holds; a level with more takes several passes
SUMS_BYTES = 256 << 20


# ---------------------------------------------------------------- bins

class Cuts(NamedTuple):
    """Thresholds of the features (None: a category's code is its bin), and the numbers of bins."""

    thresholds: tuple[tuple[float, ...] | None, ...]
    bins: tuple[int, ...]


def category_counts(data: DataFrame, features: str) -> dict[int, int]:
    """{index of a nominal feature: number of its values} by the column's metadata."""
    out = {}
    for kind, attrs in data.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).items():
        for a in attrs:
            if kind == "binary":
                out[a["idx"]] = 2
            elif kind == "nominal":
                out[a["idx"]] = len(a["vals"]) if "vals" in a else a["num_vals"]
    return out


def _thresholds(values: np.ndarray, counts: np.ndarray, expected: float, most: int) -> list[float]:
    """Candidate thresholds of one feature, by the distinct values other than 0
    of a sample that should have ``expected`` rows."""
    zeros = expected - counts.sum()
    if zeros > _EPSILON * counts.sum() * 100:
        values, counts = np.append(values, 0.0), np.append(counts.astype(float), zeros)
    order = np.argsort(values)
    values, counts = values[order], counts[order].astype(float)
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) <= most:
        return middle.tolist()
    stride = expected / (most + 1)
    out, current, target = [], counts[0], stride
    for i in range(1, len(values)):
        previous, current = current, current + counts[i]
        if abs(previous - target) < abs(current - target):
            out.append(float(middle[i - 1]))
            target += stride
    return out


def find_cuts(data: DataFrame, features: str, rows: int, width: int, max_bins: int, seed: int) -> Cuts:
    """The bins Spark ML would use for a fit on the ``rows`` rows of ``data``: from
    its sample, with each feature's values gathered in one task."""
    arity = category_counts(data, features)
    most = min(max_bins, rows)
    if not rows:
        raise ValueError("a fold leaves no rows to fit on")
    if max(arity.values(), default=0) > most:
        raise ValueError(f"a category has more than {most} values, the bins of {rows} rows")
    found: dict[int, list[float]] = {}
    if len(arity) < width:
        wanted = max(most * most, 10_000)
        fraction = wanted / rows if wanted < rows else 1.0
        spark = data.sparkSession
        plain = data.select(features)._jdf
        # the rows that ``sample`` of Spark ML's RDD takes, by their places
        drawn = plain.queryExecution().toRdd().sample(False, fraction, XorShift(seed).next_int())
        jdf = spark._jsparkSession.internalCreateDataFrame(drawn, plain.schema(), False)

        def cut(table: pa.Table) -> pa.Table:
            t = _thresholds(table["v"].to_numpy(), table["n"].to_numpy(), fraction * rows, most - 1)
            return pa.table({"i": pa.array([table["i"][0].as_py()], pa.int32()), "t": pa.array([t], pa.list_(pa.float64()))})
        counted = (DataFrame(jdf, spark).select(F.posexplode(vector_to_array(features)).alias("i", "v"))
                   .filter((F.col("v") != 0) & ~F.col("i").isin(list(arity))).groupBy("i", "v").agg(F.count("*").alias("n")))
        found = {r["i"]: r["t"] for r in counted.groupBy("i").applyInArrow(cut, "i int, t array<double>").collect()}
    thresholds = tuple(None if i in arity else tuple(found.get(i, ())) for i in range(width))
    return Cuts(thresholds, tuple(arity[i] if t is None else len(t) + 1 for i, t in enumerate(thresholds)))


def _binned(x: np.ndarray, cuts: Cuts, dtype) -> np.ndarray:
    out = np.empty((len(cuts.bins), len(x)), dtype)
    for j, t in enumerate(cuts.thresholds):
        if t is None:
            if len(x) and not (x[:, j].min() >= 0 and x[:, j].max() < cuts.bins[j]):
                raise ValueError(f"feature {j} has a code that is no category")
            out[j] = x[:, j]
        else:
            out[j] = np.searchsorted(np.array(t), x[:, j], side="left")
    return out


def blocks(prepared: DataFrame, cuts: Sequence[Cuts], folds: Sequence[int], *, fold: str, features: str, label: str,
           bags: int, seed: int, expected: dict[int, int]) -> DataFrame:
    """The rows as arrays, a block per record: fold's place, label, bins by
    ``cuts``, the rows before it in its partition without each fold's, and the
    counts of ``bags`` trees that these and the block's rows take in a forest on
    the other folds. ``expected``: about how many rows of a partition these are.
    Without ``folds`` nothing is held out."""
    dtype = np.uint8 if max(max(c.bins) for c in cuts) <= 256 else np.int32
    place = np.array(sorted(folds))

    def run(batches):
        partition = TaskContext.get().partitionId()
        stream = PoissonStream(seed + partition + 1, bags * expected.get(partition, 0)) if bags else None
        before = np.zeros(max(len(place), 1), np.int64)

        def block(held):
            nonlocal before
            t = pa.Table.from_batches(held).combine_chunks()
            at = np.searchsorted(place, t["fold"].to_numpy()) if len(place) else np.zeros(t.num_rows, np.int64)
            x = t["x"].combine_chunks()
            x = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
            after = before + len(at) - (np.bincount(at, minlength=len(place)) if len(place) else 0)
            first = int(before.min())
            drawn = stream.take(first * bags, int(after.max()) * bags) if bags else np.zeros(0, np.uint8)
            out = pa.RecordBatch.from_arrays([
                pa.array([partition], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                pa.array([t["y"].to_numpy().tobytes()], pa.binary()),
                pa.array([np.stack([_binned(x, c, dtype) for c in cuts]).tobytes()], pa.binary()),
                pa.array([(before - first).tolist()], pa.list_(pa.int64())), pa.array([drawn.tobytes()], pa.binary())],
                ["partition", "fold", "y", "bins", "before", "bags"])
            before = after
            return out
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)
    return (prepared.select(F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x"),
                            F.col(label).cast("double").alias("y"))
            .mapInArrow(run, "partition int, fold binary, y binary, bins binary, before array<long>, bags binary")
            .persist(StorageLevel.MEMORY_AND_DISK))


def arrays(batches, n_cuts: int, width: int):
    """(record, folds' places, labels, bins as cuts x features x rows) of each block."""
    for record in (row for batch in batches for row in batch.to_pylist()):
        fold, y = np.frombuffer(record["fold"], np.int32), np.frombuffer(record["y"])
        size = len(record["bins"]) // (n_cuts * width * len(fold))
        yield record, fold, y, np.frombuffer(record["bins"], np.uint8 if size == 1 else np.int32).reshape(n_cuts, width, len(fold))


# ---------------------------------------------------------------- trees

class Grown(NamedTuple):
    """A tree by node number; 0 is the root, a node's right child comes after its
    left one, and a leaf is its own left child. ``right`` holds, by node and bin,
    the bits of what goes right."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    width: int
    depth: int
    prediction: np.ndarray

    def levels(self, bins: np.ndarray):
        """The node of every column of ``bins`` (features x rows), level by level
        from the root; a row that has reached a leaf stays there."""
        n = bins.shape[1]
        node = np.zeros(n, np.intp)
        yield node
        if self.depth:
            goes_right = np.unpackbits(self.right, axis=1, count=self.width)
            node = self.left[0] + goes_right[0].take(bins[self.feature[0]])
            yield node
        if self.depth > 1:
            flat, own, goes_right = bins.reshape(-1), np.arange(n), goes_right.reshape(-1)
            offset, row = self.feature * n, np.arange(len(self.left)) * self.width
            for _ in range(self.depth - 1):
                at = offset.take(node)
                at += own
                go = row.take(node)
                go += flat.take(at)
                node = self.left.take(node)
                node += goes_right.take(go)
                yield node

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        for node in self.levels(bins):
            pass
        return node

    def by_depth(self, bins: np.ndarray, depths: Sequence[int]) -> dict[int, np.ndarray]:
        """Predictions of the tree cut at each depth."""
        out = {}
        for level, node in enumerate(self.levels(bins)):
            if level in depths or level == self.depth:
                y = self.prediction.take(node)
                out.update({d: y for d in depths if d == level or level == self.depth < d})
        return out


class Request(NamedTuple):
    """One tree's next nodes: the sums of their rows are wanted."""

    fold: int                                    # place of the fold that is held out, -1: none
    cuts: int
    bag: int                                     # tree of the forest, -1: every row once
    earlier: tuple[tuple[Grown, float], ...]     # of a boosted chain
    tree: Grown
    nodes: np.ndarray
    features: np.ndarray | None                  # by node, None: all
    impurity: np.ndarray                         # NaN: root
    bins: tuple[int, ...]
    min_rows: int
    min_gain: float
    categorical: tuple[bool, ...]

    def starts(self) -> tuple[np.ndarray, int]:
        """Where the sums of each (node, feature) start, and their number."""
        bins = np.array(self.bins)
        sizes = np.tile(bins, (len(self.nodes), 1)) if self.features is None else bins[self.features]
        ends = np.cumsum(sizes)
        return (ends - sizes.reshape(-1)).reshape(sizes.shape), int(ends[-1])


def _histograms(requests: Sequence[Request], bags: int, n_cuts: int):
    """For ``mapInArrow`` over blocks: (tree, partition, sums) of all requests."""
    def run(batches):
        starts = [r.starts() for r in requests]
        total = [(np.zeros(n, np.int64), np.zeros(n), np.zeros(n)) for _, n in starts]
        slots = []
        for r in requests:
            slot = np.full(len(r.tree.left), -1)
            slot[r.nodes] = np.arange(len(r.nodes))
            slots.append(slot)
        by_fold: dict[tuple[int, int], list[int]] = {}
        for i, r in enumerate(requests):
            by_fold.setdefault((r.fold, r.cuts), []).append(i)
        partition = -1
        for record, fold, y, bins in arrays(batches, n_cuts, len(requests[0].bins)):
            partition = record["partition"]
            for (held, cut), mine in by_fold.items():
                rows = np.flatnonzero(fold != held)
                x, target = bins[cut].take(rows, axis=1), y[rows]
                drawn = np.frombuffer(record["bags"], np.uint8)
                if bags and any(requests[i].bag >= 0 for i in mine):
                    first = record["before"][held] * bags
                    drawn = np.ascontiguousarray(drawn[first:first + len(rows) * bags].reshape(-1, bags).T)
                for i in mine:
                    _add(requests[i], x, target, drawn[requests[i].bag] if requests[i].bag >= 0 else None,
                         slots[i], starts[i][0], total[i])
        if partition >= 0:
            for i, sums in enumerate(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([partition], pa.int32()),
                     *[pa.array([s.tobytes()], pa.binary()) for s in sums]], ["tree", "partition", "n", "s", "q"])
    return run


def _add(r: Request, x, y, weight, slots, starts, total) -> None:
    if weight is not None:
        drawn = np.flatnonzero(weight)
        x, y, weight = x.take(drawn, axis=1), y[drawn], weight[drawn].astype(np.float64)
    if r.earlier:
        so_far = 0.0
        for tree, by in r.earlier:
            so_far = so_far + (tree.prediction * by).take(tree.leaves(x))
        y = 2.0 * (y - so_far)
    slot = slots.take(r.tree.leaves(x))
    inside = np.flatnonzero(slot >= 0)
    if len(inside) < len(slot):
        x, y, slot = x.take(inside, axis=1), y[inside], slot[inside]
        weight = None if weight is None else weight[inside]
    wy = y if weight is None else weight * y
    wyy = wy * y
    size, n = len(total[0]), len(slot)
    flat, own = x.reshape(-1), np.arange(n)
    for j in range(starts.shape[1]):
        key = starts[:, j].take(slot)
        key += x[j] if r.features is None else flat.take(r.features[:, j].take(slot) * n + own)
        if weight is None:
            total[0][:] += np.bincount(key, minlength=size)
        else:
            total[0][:] += np.bincount(key, weight, minlength=size).astype(np.int64)
        total[1][:] += np.bincount(key, wy, minlength=size)
        total[2][:] += np.bincount(key, wyy, minlength=size)


def _variance(n, s, q):
    return np.where(n > 0, (q - s * s / np.maximum(n, 1)) / np.maximum(n, 1), 0.0)


class Split(NamedTuple):
    """The best split of a node. ``code`` is the last bin that goes left, or the
    categories that do; left and right are (rows, sum, sum of squares)."""

    gain: float
    feature: int
    code: object
    left: tuple[float, float, float]
    right: tuple[float, float, float]


def best_splits(r: Request, n: np.ndarray, s: np.ndarray, q: np.ndarray) -> list[Split]:
    """The split of the largest gain of every node, the first of equal ones."""
    starts, _ = r.starts()
    best: list[Split] = []
    gains = np.full(starts.shape, -np.inf)
    found: dict[tuple[int, int], tuple] = {}
    impurity = r.impurity.copy()
    of = np.tile(np.arange(len(r.bins)), (len(r.nodes), 1)) if r.features is None else r.features
    for f, width in enumerate(r.bins):
        node, j = np.nonzero(of == f)
        if width < 2 or not len(node):
            continue
        at = starts[node, j][:, None] + np.arange(width)
        hn, hs, hq = n[at].astype(float), s[at], q[at]
        order = None
        if r.categorical[f]:
            centre = np.where(hn > 0, hs / np.maximum(hn, 1), np.finfo(np.float64).max)
            order = np.argsort(centre, axis=1, kind="stable")
            hn, hs, hq = (np.take_along_axis(h, order, 1) for h in (hn, hs, hq))
        hn, hs, hq = np.cumsum(hn, 1), np.cumsum(hs, 1), np.cumsum(hq, 1)
        left = hn[:, :-1], hs[:, :-1], hq[:, :-1]
        right = tuple(h[:, -1:] - lo for h, lo in zip((hn, hs, hq), left))
        own = np.where(np.isnan(impurity[node]), _variance(left[0][:, 0] + right[0][:, 0], left[1][:, 0] + right[1][:, 0],
                                                           left[2][:, 0] + right[2][:, 0]), impurity[node])[:, None]
        impurity[node] = own[:, 0]
        rows = left[0] + right[0]
        some = np.maximum(rows, 1)
        gain = own - left[0] / some * _variance(*left) - right[0] / some * _variance(*right)
        gain[(left[0] < r.min_rows) | (right[0] < r.min_rows) | ~(gain >= r.min_gain)] = _INVALID
        split = gain.argmax(1)
        own = np.arange(len(node))
        gains[node, j] = gain[own, split]
        for k, (a, b) in enumerate(zip(node, j)):
            at = split[k]
            found[a, b] = (f, order[k, :at + 1].copy() if order is not None else int(at),
                           tuple(float(v[k, at]) for v in left), tuple(float(v[k, at]) for v in right))
    for node, j in enumerate(gains.argmax(1)):
        if (node, j) in found:
            best.append(Split(float(gains[node, j]), *found[node, j]))
        else:                                    # its features are constant
            one = slice(starts[node, 0], starts[node, 0] + r.bins[of[node, 0]])
            best.append(Split(_INVALID, 0, 0, (float(n[one].sum()), float(s[one].sum()), float(q[one].sum())), (0.0, 0.0, 0.0)))
    return best


class _Growth:
    """A tree while it grows."""

    def __init__(self, cuts: Cuts):
        self.cuts = cuts
        self.width = max(cuts.bins)
        self.feature, self.left, self.right, self.level = [0], [0], [np.zeros(self.width, np.uint8)], [0]
        self.prediction, self.impurity, self.sums = [np.nan], [np.nan], [(0.0, 0.0, 0.0)]
        self.inner: dict[int, object] = {}       # node: code of its split
        self.gain: dict[int, float] = {}

    def split(self, node: int, found: Split, max_depth: int) -> list[int]:
        """Take a node's split; returns the children that can be split in turn."""
        if node == 0:
            self.sums[0] = n, s, _ = tuple(a + b for a, b in zip(found.left, found.right))
            self.prediction[0] = s / n if n else 0.0
        if found.gain <= 0:
            return []
        self.feature[node], self.left[node] = found.feature, len(self.left)
        goes_right = np.ones(self.width, np.uint8)
        if isinstance(found.code, np.ndarray):
            goes_right[found.code] = 0
        else:
            goes_right[:found.code + 1] = 0
        self.right[node], self.inner[node], self.gain[node] = goes_right, found.code, found.gain
        deeper, out = self.level[node] + 1, []
        for n, s, q in (found.left, found.right):
            child = len(self.left)
            self.feature.append(0)
            self.left.append(child)
            self.right.append(np.zeros(self.width, np.uint8))
            self.level.append(deeper)
            self.prediction.append(s / n if n else 0.0)
            self.impurity.append(float(_variance(n, s, q)))
            self.sums.append((n, s, q))
            if deeper < max_depth and abs(self.impurity[child]) >= _EPSILON:
                out.append(child)
        return out

    def nodes(self) -> list[tuple]:
        """The fields of Spark ML's persisted nodes."""
        out = []
        for k, (n, s, q) in enumerate(self.sums):
            code, f = self.inner.get(k), self.feature[k]
            if code is None:
                split = -1, [], -1
            elif isinstance(code, np.ndarray):
                split = f, code.astype(float).tolist(), self.cuts.bins[f]
            else:
                split = f, [self.cuts.thresholds[f][code]], -1
            child = -1 if code is None else self.left[k]
            out.append({"id": k, "prediction": float(self.prediction[k]), "impurity": float(_variance(n, s, q)),
                        "impurityStats": [n, s, q], "rawCount": int(n), "gain": self.gain.get(k, -1.0), "leftChild": child,
                        "rightChild": child + (code is not None), "split": dict(zip(
                            ("featureIndex", "leftCategoriesOrThreshold", "numCategories"), split))})
        return out

    def grown(self) -> Grown:
        return Grown(np.array(self.feature), np.array(self.left), np.packbits(np.stack(self.right), axis=1),
                     self.width, max(self.level), np.array(self.prediction))


class Fit(NamedTuple):
    """A tree (``trees`` 1), forest or boosted chain on all folds but one."""

    kind: str
    fold: int
    depth: int
    trees: int
    seed: int
    cuts_number: int
    cuts: Cuts
    min_rows: int
    min_gain: float
    step: float
    per_node: int                                # features drawn for a node
    memory: int                                  # bytes of a group of nodes; its end decides the draws


class _Job:
    """The state of a fit between the passes."""

    def __init__(self, fit: Fit):
        self.fit = fit
        together = fit.trees if fit.kind == "forest" else 1
        self.done: list[_Growth] = []
        self.random = JavaRandom(fit.seed)
        self.open = [_Growth(fit.cuts) for _ in range(together)]
        self.stack = [(t, 0) for t in range(together)]            # the last one is the top

    def group(self) -> dict[int, list[tuple[int, list[int] | None]]]:
        """{tree: its next nodes with their features}."""
        out: dict[int, list] = {}
        used, bins = 0, self.fit.cuts.bins
        while self.stack and used < max(self.fit.memory, 1):
            tree, node = self.stack[-1]
            drawn = None
            if self.fit.per_node < len(bins):
                drawn = drawn_features(len(bins), self.fit.per_node, self.random.next_long())
                need = 3 * 8 * sum(bins[f] for f in drawn)
                if used and used + need > self.fit.memory:
                    break
                used += need
            self.stack.pop()
            out.setdefault(tree, []).append((node, drawn))
        return out

    def requests(self) -> list[tuple[int, Request]]:
        fit = self.fit
        earlier = tuple((g.grown(), 1.0 if k == 0 else fit.step) for k, g in enumerate(self.done)) if fit.kind == "boosted" else ()
        out = []
        for tree, nodes in sorted(self.group().items()):
            growth = self.open[tree]
            out.append((tree, Request(
                fit.fold, fit.cuts_number, tree if fit.kind == "forest" else -1, earlier, growth.grown(),
                np.array([n for n, _ in nodes]), None if nodes[0][1] is None else np.array([f for _, f in nodes]),
                np.array([growth.impurity[n] for n, _ in nodes]), fit.cuts.bins, fit.min_rows, fit.min_gain,
                tuple(t is None for t in fit.cuts.thresholds))))
        return out

    def take(self, found: Iterable[tuple[int, np.ndarray, list[Split]]]) -> None:
        of = {tree: (nodes, splits) for tree, nodes, splits in found}
        for tree in map_order(list(of)):
            for node, split in zip(of[tree][0].tolist(), of[tree][1]):
                self.stack += [(tree, c) for c in self.open[tree].split(node, split, self.fit.depth)]
        if not self.stack:
            self.done += self.open
            if self.fit.kind == "boosted" and len(self.done) < self.fit.trees:
                self.open, self.stack = [_Growth(self.fit.cuts)], [(0, 0)]
            else:
                self.open = []

    @property
    def finished(self) -> bool:
        return not self.open


def _solve(data: DataFrame, requests: list[Request], bags: int, n_cuts: int) -> list[list[Split]]:
    """One pass: the best splits of all requests."""
    spark = data.sparkSession
    shipped = spark.sparkContext.broadcast(requests)

    def add(batches):
        yield from _histograms(shipped.value, bags, n_cuts)(batches)

    def reduce(table: pa.Table) -> pa.Table:
        number = table["tree"][0].as_py()
        sums = None
        for k in np.argsort(table["partition"].to_numpy(), kind="stable").tolist():
            one = [np.frombuffer(table[c][k].as_py(), t) for c, t in (("n", np.int64), ("s", float), ("q", float))]
            sums = one if sums is None else [a + b for a, b in zip(sums, one)]
        found = pickle.dumps(best_splits(shipped.value[number], *sums))
        return pa.table({"tree": pa.array([number], pa.int32()), "found": pa.array([found], pa.binary())})
    out: list[list[Split]] = [[] for _ in requests]
    found = (data.mapInArrow(add, "tree int, partition int, n binary, s binary, q binary")
             .groupBy("tree").applyInArrow(reduce, "tree int, found binary").collect())
    for r in found:
        out[r["tree"]] = pickle.loads(r["found"])
    shipped.destroy()
    return out


def grow(data: DataFrame, fits: Sequence[Fit], bags: int, n_cuts: int) -> list[list[_Growth]]:
    """The trees of every fit, grown level by level over the blocks ``data``."""
    jobs = [_Job(f) for f in fits]
    while any(not j.finished for j in jobs):
        asked: dict[bytes, int] = {}
        requests: list[Request] = []
        waiting = []
        for job in (j for j in jobs if not j.finished):
            mine = []
            for tree, request in job.requests():
                key = pickle.dumps(request)      # chains begin alike: asked once
                if key not in asked:
                    asked[key] = len(requests)
                    requests.append(request)
                mine.append((tree, request.nodes, asked[key]))
            waiting.append((job, mine))
        sizes, parts = [24 * r.starts()[1] for r in requests], [[]]
        held = 0
        for i, size in enumerate(sizes):
            if parts[-1] and held + size > SUMS_BYTES:
                parts.append([])
                held = 0
            parts[-1].append(i)
            held += size
        splits: dict[int, list] = {}
        for part in parts:
            splits.update(zip(part, _solve(data, [requests[i] for i in part], bags, n_cuts)))
        for job, mine in waiting:
            job.take([(tree, nodes, splits[i]) for tree, nodes, i in mine])
    return [j.done for j in jobs]
