"""Co-moments of many column pairs from one scan (F6, and the sums that linear
models are solved from).

``corr(x, y)`` for every pair needs one aggregate expression per pair, which
stops fitting into generated code beyond some forty columns. Here every task
keeps, for all pairs at once, the count, means and centred products as four
matrix products per Arrow batch, and leaves them as square blocks of the
matrix. Blocks of the same place meet in one task, sorted, and are merged one
after the other, so a task holds a single block and the driver nothing.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: columns on a side of a block: 6 matrices of 64 x 64 doubles are 196 kB
BLOCK = 64
#: rows of a batch that are multiplied at once
ROWS = 4096
_PARTS = ("n", "mean_x", "mean_y", "c_xx", "c_yy", "c_xy")


class PairSums:
    """Sums over rows of all pairs of columns, taken relative to the first rows' means."""

    def __init__(self, p: int):
        self.center = None
        self.n, self.s, self.q, self.c = (np.zeros((p, p)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        """Rows of ``x``; NaN marks a missing value."""
        there = ~np.isnan(x)
        if self.center is None:
            count = there.sum(axis=0)
            self.center = np.where(there, x, 0.0).sum(axis=0) / np.maximum(count, 1)
        z = np.where(there, x - self.center, 0.0)
        self.c += z.T @ z
        if there.all():
            self.n += len(x)
            self.s += z.sum(axis=0)[:, None]
            self.q += (z * z).sum(axis=0)[:, None]
        else:
            m = there.astype(np.float64)
            self.n += m.T @ m
            self.s += z.T @ m
            self.q += (z * z).T @ m

    def moments(self) -> list[np.ndarray]:
        """n, mean_x, mean_y, c_xx, c_yy, c_xy of every pair (x in rows)."""
        some = np.maximum(self.n, 1)
        mean = self.s / some
        cxx = self.q - self.s * mean
        return [self.n, mean + self.center[:, None], mean.T + self.center[None, :], cxx, cxx.T,
                self.c - self.s * mean.T]


def merge(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The moments of both sets of rows together (the pairwise update of Chan et al.)."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy = b[1] - a[1], b[2] - a[2]
    w = a[0] * share
    return [n, a[1] + dx * share, a[2] + dy * share,
            a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w]


_STATE = "key int, bi int, bj int, " + ", ".join(f"{p} binary" for p in _PARTS)


def _sums(p: int):
    def run(batches):
        states: dict[int, PairSums] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[1:]])
            for key in np.unique(keys):
                rows = x[keys == key]
                state = states.setdefault(int(key), PairSums(p))
                for at in range(0, len(rows), ROWS):
                    state.add(rows[at:at + ROWS])
        for key, state in states.items():
            parts = state.moments()
            for bi in range(0, p, BLOCK):
                for bj in range(bi, p, BLOCK):
                    cut = [np.ascontiguousarray(m[bi:bi + BLOCK, bj:bj + BLOCK]).tobytes() for m in parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], pa.int32()) for v in (key, bi, bj)] + [pa.array([v], pa.binary()) for v in cut],
                        ["key", "bi", "bj", *_PARTS])
    return run


def _merged(p: int):
    """Blocks come sorted; neighbours of the same place are merged and written out as pairs."""
    def pairs(place, parts):
        key, bi, bj = place
        wide = min(BLOCK, p - bj)
        x, y = np.divmod(np.arange(len(parts[0])), wide)
        x, y = x + bi, y + bj
        keep = x <= y
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(keep.sum(), key), pa.int32()), pa.array(x[keep], pa.int32()), pa.array(y[keep], pa.int32()),
             pa.array(parts[0][keep], pa.int64(), safe=False)] + [pa.array(m[keep], pa.float64()) for m in parts[1:]],
            ["key", "x", "y", *_PARTS])

    def run(batches):
        place, state = None, None
        for batch in batches:
            places = list(zip(*[batch.column(k).to_pylist() for k in range(3)]))
            for row, here in enumerate(places):
                parts = [np.frombuffer(batch.column(3 + k)[row].as_buffer(), np.float64) for k in range(len(_PARTS))]
                if here == place:
                    state = merge(state, parts)
                else:
                    if place is not None:
                        yield pairs(place, state)
                    place, state = here, [m.copy() for m in parts]
        if place is not None:
            yield pairs(place, state)
    return run


def co_moments(df: DataFrame, cols: Sequence[str], key: str | None = None) -> DataFrame:
    """(key, x, y, n, mean_x, mean_y, c_xx, c_yy, c_xy) of every unordered pair of
    ``cols``, a column with itself included: ``x`` and ``y`` are positions in
    ``cols``, ``c_*`` sums of centred products over the rows that have both.

    Rows where either value is null or NaN are left out of a pair (pairwise
    deletion). ``key`` is an integer column with few values, each summed on its
    own (0 without it; rows whose key is null are left out). One scan for any
    number of columns; what is shuffled grows with tasks and pairs, not rows. An
    empty table has no rows.
    """
    p = len(cols)
    keyed = df.select((F.col(key).cast("int") if key else F.lit(0)).alias("_key"),
                      *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    states = keyed.filter("_key IS NOT NULL").mapInArrow(_sums(p), _STATE)
    dealt = states.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return dealt.mapInArrow(_merged(p), "key int, x int, y int, n long, mean_x double, mean_y double, "
                                        "c_xx double, c_yy double, c_xy double")
