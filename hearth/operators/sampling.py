"""Top-k, shuffles, splits, samples and folds.

Random choices are hash draws of a row key and a seed (``unit_hash``), not
a generator stream: the same rows are chosen for any partitioning and on
any re-execution of a task, which keeps complements exact after executor
loss.
"""

from __future__ import annotations

import itertools
import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hearth.functions.scalar import unit_hash
from hearth.operators.ranking import column_quantiles, global_rank

MAX_FILES = 200_000     # their paths and first positions are some 40 MB


def _draw(key: str, seed: int, draw: Column | None) -> Column:
    return draw if draw is not None else unit_hash(key, seed)


def sort_desc(df: DataFrame, col: str, tie: str | None = None,
              position: str | None = None) -> DataFrame:
    """Descending sort (G1); range-partitioned, no single task. ``position``
    names a column for each row's 1-based place; ``tie`` must then be unique."""
    if position:
        return global_rank(df, [F.desc(col), F.asc(tie)], rank_col=position)[0]
    return df.orderBy(F.desc(col), *([F.asc(tie)] if tie else []))


def top_k(df: DataFrame, col: str, k: int, *, id_col: str | None = None,
          ascending: bool = False) -> DataFrame:
    """k rows with the largest (or smallest) ``col``, ties by id.

    Planned as TakeOrderedAndProject: each partition keeps k rows.
    """
    order = F.asc(col) if ascending else F.desc(col)
    return df.orderBy(order, *([F.asc(id_col)] if id_col else [])).limit(int(k))


def extremes(df: DataFrame, col: str, k: int, id_col: str) -> DataFrame:
    """The k lowest and k highest values with a ``side`` tag."""
    low = top_k(df, col, k, id_col=id_col, ascending=True).withColumn("side", F.lit("low"))
    high = top_k(df, col, k, id_col=id_col).withColumn("side", F.lit("high"))
    return low.unionByName(high)


def shuffle_rows(df: DataFrame, key: str, seed: int, *, draw: Column | None = None,
                 order_col: str = "shuffle_pos") -> DataFrame:
    """Random permutation (G5): rows ordered by a hashed draw, ties by key.

    Returns the rows with their 1-based position in the permutation from the
    distributed global rank.
    """
    base = df.withColumn("_u", _draw(key, seed, draw))
    ranked, _ = global_rank(base, ["_u", key], rank_col=order_col)
    return ranked.drop("_u")


def file_positions(df: DataFrame, out: str = "position") -> tuple[DataFrame, int]:
    """The rows of a just read Parquet table with their 0-based position, files
    in the order of their paths, and the number of rows.

    A row's place in its file comes with the scan, so neither retries nor the
    partitioning change it, and no row is sorted or shuffled. The files' first
    positions are a table of one row a file, ``MAX_FILES`` at most. Rows
    lost or repeated since the table was read raise ValueError where they leave
    positions that are not 0 to n - 1.
    """
    place = df.select(F.struct("*").alias("_values"), F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.row_index").alias("_row"))
    files = place.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), F.max("_row").alias("last"))
    r = files.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum(F.col("last") + 1).alias("ends")).first()
    if r["rows"] != r["ends"]:
        raise ValueError("positions need the whole table: rows were lost or repeated since it was read")
    if r["files"] > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} files: use shuffle_rows, which ranks by a hash draw")
    counts = sorted((f["_file"], f["rows"]) for f in files.collect())
    starts = itertools.accumulate((c for _, c in counts), initial=0)
    first = F.broadcast(df.sparkSession.createDataFrame(
        [(f, at) for (f, _), at in zip(counts, starts)], "_file string, _first long"))
    rows = place.join(first, "_file").select("_values.*", (F.col("_first") + F.col("_row")).alias(out))
    return rows, r["rows"] or 0


def permuted(position: Column, n: int, seed: int) -> Column:
    """A keyed permutation of 0 .. n - 1, exact for every n.

    Three times four Feistel rounds on Z_a x Z_b, a = floor(sqrt(n)) and
    b = floor(n / a); the fewer than a positions beyond a * b wait. After four
    rounds all positions are rotated by a keyed step, so that others wait.
    """
    a = math.isqrt(n)
    b = n // a
    seed, a_, b_, n_ = (F.lit(v).cast("long") for v in (seed, a, b, n))

    def step(s, k):
        left, right, kind = s["l"], s["r"], k % 5
        at = F.pmod(left * b_ + right + F.pmod(F.xxhash64(seed, k), n_), n_)
        inside = left < a_
        return F.struct(
            F.when(kind == 4, ((at - F.pmod(at, b_)) / b_).cast("long")).when(inside & (kind % 2 == 0), F.pmod(left + F.pmod(F.xxhash64(seed, k, right), a_), a_))
            .otherwise(left).alias("l"),
            F.when(kind == 4, F.pmod(at, b_)).when(inside & (kind % 2 == 1), F.pmod(right + F.pmod(F.xxhash64(seed, k, left), b_), b_))
            .otherwise(right).alias("r"))
    x = position.cast("long")
    start = F.struct(((x - F.pmod(x, b_)) / b_).cast("long").alias("l"), F.pmod(x, b_).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(14)), start, step, lambda s: s["l"] * b_ + s["r"])


def shuffle_positions(df: DataFrame, seed: int, order_col: str = "shuffle_pos") -> DataFrame:
    """Random permutation of a just read Parquet table (G5) without a sort: the
    rows with their 1-based place, which is their position in the table under a
    keyed permutation. No row is shuffled; write in ranges of ``order_col`` to
    bring the rows into that order. Every row has a place of its own, repeated
    rows too; an empty table stays empty."""
    rows, n = file_positions(df, order_col)
    return rows.withColumn(order_col, permuted(F.col(order_col), n, seed) + 1) if n else rows


def weighted_split(df: DataFrame, weights: Sequence[float], key: str, seed: int, *,
                   draw: Column | None = None) -> list[DataFrame]:
    """Random split with weights normalised to sum 1 (H1): 0.9/0.2 gives
    81.8% / 18.2%. The splits are disjoint and cover every row."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = acc
        acc += w / total
        bounds.append((lo, acc))
    u = _draw(key, seed, draw)
    out = []
    for i, (lo, hi) in enumerate(bounds):
        cond = (u >= F.lit(lo)) & ((u < F.lit(hi)) if i < len(bounds) - 1 else F.lit(True))
        out.append(df.filter(cond))
    return out


def split_label(df: DataFrame, weights: Sequence[float], key: str, seed: int, *,
                draw: Column | None = None, out: str = "split") -> DataFrame:
    """The same split as :func:`weighted_split` as a column (0, 1, ...)."""
    total = float(sum(weights))
    u = _draw(key, seed, draw)
    expr, acc = None, 0.0
    for i, w in enumerate(weights[:-1]):
        acc += w / total
        expr = (F.when(u < F.lit(acc), F.lit(i)) if expr is None
                else expr.when(u < F.lit(acc), F.lit(i)))
    last = F.lit(len(weights) - 1)
    return df.withColumn(out, last if expr is None else expr.otherwise(last))


def exact_sample(df: DataFrame, fraction: float, key: str, seed: int, *,
                 draw: Column | None = None, out: str = "in_sample") -> DataFrame:
    """Sample of exactly floor(fraction * n) rows without replacement, plus
    its complement, flagged in ``out`` (H2).

    The sample has the rows with the smallest (draw, key). The draw that ends
    it is selected by passes over the draws (``ranking.column_quantiles``), and
    rows are flagged by comparison with it: no row is sorted or shuffled, but
    for those with exactly that draw, if only some of them belong to the sample
    (they are ranked by key).
    """
    base = df.withColumn("_u", _draw(key, seed, draw))
    n = base.count()
    size = int(fraction * n)
    if size <= 0 or size >= n:
        return base.withColumn(out, F.lit(size > 0)).drop("_u")
    # halfway between the last draw of the sample and the first behind it
    cut = column_quantiles(base, ["_u"], [(size - 0.5) / (n - 1)])["_u"][0]
    below = base.filter(F.col("_u") < cut).count()
    if below == size:
        return base.withColumn(out, F.col("_u") < cut).drop("_u")
    ranked, _ = global_rank(base.filter(F.col("_u") == cut), [key], rank_col="_rk")
    tied = ranked.withColumn(out, F.col("_rk") <= size - below).drop("_rk")
    rest = base.filter(F.col("_u") != cut).withColumn(out, F.col("_u") < cut)
    return rest.unionByName(tied).drop("_u")


def fold_column(df: DataFrame, k: int, key: str, seed: int, *,
                draw: Column | None = None, out: str = "fold") -> DataFrame:
    """k-fold assignment (H3): fold = floor(draw * k), an int in [0, k)."""
    u = _draw(key, seed, draw)
    return df.withColumn(out, F.least(F.floor(u * F.lit(int(k))).cast("int"), F.lit(int(k) - 1)))
