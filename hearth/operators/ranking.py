"""Global ranks and exact quantiles without a single-task window.

``row_number() OVER (ORDER BY x)`` with no PARTITION BY moves every row to
one task. Here ranks are computed like a distributed prefix sum:

1. range-partition on the (total) order and sort within partitions,
2. freeze row positions with ``monotonically_increasing_id`` and cut the
   lineage with ``checkpoint()`` (reliable storage under
   ``spark.checkpoint.dir``), so re-execution after executor loss sees the
   same rows in the same places,
3. count rows per partition (a result bounded by the partition count),
4. add the partition's offset to the in-partition position.

Exact quantiles do not sort at all: see :func:`column_quantiles`.
"""

from __future__ import annotations

import math
import struct
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hearth.functions.scalar import count_below
from hearth.session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    """Range partitions: as many as the input has (sized by the scan's
    ``maxPartitionBytes``) and at least ``spark.sql.shuffle.partitions``."""
    if num_partitions:
        return int(num_partitions)
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        return max(configured, df.rdd.getNumPartitions())
    except Exception:  # no RDD view (Connect): the configured count
        return configured


def global_rank(df: DataFrame, order: Sequence[Column | str], *,
                rank_col: str = "rank", num_partitions: int | None = None
                ) -> tuple[DataFrame, int]:
    """1-based ``row_number`` over ``order`` for every row, and the row count.

    ``order`` must be a total order (end it with a unique key) so the ranks
    are deterministic; the unique key also lets range bounds split a hot
    value over several partitions. The per-partition start offsets form a
    table with one row per partition, joined by broadcast (its size is the
    partition count, not the data).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    n_parts = _num_partitions(df, num_partitions)
    placed = (df.repartitionByRange(n_parts, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = sorted((int(r["p"]), int(r["n"])) for r in
                    placed.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, acc = [], 0
    for p, n in counts:
        starts.append((p, acc))
        acc += n
    offsets = spark.createDataFrame(starts, "_p long, _start long")
    ranked = (placed.withColumn("_p", pid)
                    .join(F.broadcast(offsets), "_p")
                    .withColumn(rank_col, F.col("_start") + pos + 1)
                    .drop("_mid", "_p", "_start"))
    return ranked, acc


def _bit_steps(lo: float, hi: float, n: int) -> list[float]:
    """Up to ``n`` doubles between two, evenly spaced in the order of all doubles."""
    def place(x: float) -> int:
        k = struct.unpack("<q", struct.pack("<d", x))[0]
        return k if k >= 0 else -(k & 0x7FFFFFFFFFFFFFFF)

    def value(k: int) -> float:
        x = struct.unpack("<d", struct.pack("<q", abs(k)))[0]
        return x if k >= 0 else -x
    a, b = place(lo), place(hi)
    return sorted({value(a + (b - a) * k // (n + 1)) for k in range(1, n + 1)} - {lo})


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *,
                     bins: int = 2048, max_fetch: int = 50_000
                     ) -> dict[str, list[float | None]]:
    """Exact quantiles of several numeric columns by multi-pass selection.

    Same definition as SQL ``percentile`` / ``quantile_cont``: position
    ``h = (n - 1) p`` over the non-null, non-NaN values, and
    ``x[floor h] + (h - floor h)(x[ceil h] - x[floor h])``.

    Each wanted order statistic keeps a value bracket ``[lo, hi]`` and its
    rank inside the bracket. One pass is one scan, filtered to the open
    brackets (the filter reaches the Parquet reader), with a partial
    aggregate of (count, min, max) per bucket of each bracket. The bucket
    holding the rank becomes the next bracket, bounded by the values actually
    seen in it. Every other pass cuts a bracket into equal widths, which suits
    most columns; the passes between cut it at 63 even steps of the doubles'
    bit patterns, so for any distribution a bracket is down to one value
    after at most eleven of those. Brackets with few rows (``max_fetch`` for
    all of them together) are resolved from their ``(value, count)`` pairs.
    Infinities count as ordinary extremes. No sort or shuffle of the data is
    needed, and a value held by a third of all rows is one aggregate group.
    """
    cols = list(cols)

    def unpivot(src: DataFrame) -> DataFrame:
        return src.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("g"), F.col(c).cast("double").alias("v")) for c in cols
        ])).alias("s")).select("s.g", "s.v").where(F.col("v").isNotNull() & ~F.isnan("v"))

    finite = F.abs("v") < F.lit(math.inf)

    def narrowed(open_brackets) -> DataFrame:
        # The same bracket test on the source columns, before the unpivot,
        # so Catalyst can push it into the Parquet reader (row-group skipping
        # by min/max statistics); the exact per-column test follows.
        pre = F.lit(False)
        for c, lo, hi, _ in open_brackets:
            pre = pre | F.col(c).cast("double").between(lo, hi)
        return unpivot(df.where(pre))

    long = unpivot(df)
    stats = {r["g"]: r for r in long.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("v") == -math.inf, 1)).alias("low_inf"),
        F.count(F.when(F.col("v") == math.inf, 1)).alias("high_inf"),
        F.min(F.when(finite, F.col("v"))).alias("lo"), F.max(F.when(finite, F.col("v"))).alias("hi")).collect()}

    # wanted[(col, k)] = value of the k-th smallest (0-based)
    wanted: dict[tuple[str, int], float | None] = {}
    # open brackets: key -> (col, lo, hi, n_rows); ranks: (col, k) -> (key, rank in bracket)
    brackets: dict[int, tuple[str, float, float, int]] = {}
    ranks: dict[tuple[str, int], tuple[int, int]] = {}
    for c in cols:
        st = stats.get(c)
        if st is None or st["n"] == 0:
            continue
        inner = int(st["n"] - st["low_inf"] - st["high_inf"])
        key = len(brackets)
        if inner:
            brackets[key] = (c, float(st["lo"]), float(st["hi"]), inner)
        for p in probs:
            h = (st["n"] - 1) * float(p)
            for k in {int(math.floor(h)), int(math.ceil(h))}:
                r = k - st["low_inf"]
                if r < 0 or r >= inner:
                    wanted[(c, k)] = -math.inf if r < 0 else math.inf
                elif r in (0, inner - 1):      # known from the first pass
                    wanted[(c, k)] = float(st["lo"] if r == 0 else st["hi"])
                else:
                    ranks[(c, k)] = (key, r)

    passes = 0
    while ranks:
        live = {}
        for ck, (key, r) in list(ranks.items()):
            c, lo, hi, n = brackets[key]
            if lo == hi:                       # one distinct value left
                wanted[ck] = lo
                del ranks[ck]
            else:
                live[key] = brackets[key]
        if not ranks:
            break
        fetch, room = {}, max_fetch
        for k, b in sorted(live.items(), key=lambda x: x[1][3]):
            if b[3] <= room:
                fetch[k] = b
                room -= b[3]
        split = {k: b for k, b in live.items() if k not in fetch}
        passes += 1
        if fetch:
            cond = F.lit(False)
            for key, (c, lo, hi, _) in fetch.items():
                cond = cond | ((F.col("g") == c) & F.col("v").between(lo, hi))
            pairs = (narrowed(fetch.values()).where(cond).groupBy("g", "v")
                         .agg(F.count(F.lit(1)).alias("w")).collect())
            for ck, (key, r) in list(ranks.items()):
                if key not in fetch:
                    continue
                c, lo, hi, _ = fetch[key]
                vals = sorted((row["v"], row["w"]) for row in pairs
                              if row["g"] == c and lo <= row["v"] <= hi)
                acc = 0
                for v, w in vals:
                    acc += w
                    if r < acc:
                        wanted[ck] = float(v)
                        break
                del ranks[ck]
        if split:
            cond = F.lit(False)
            bucket = None
            for key, (c, lo, hi, _) in split.items():
                inside = (F.col("g") == c) & F.col("v").between(lo, hi)
                cond = cond | inside
                if passes % 2:
                    # halves keep hi - lo finite for brackets spanning most doubles
                    width = hi * 0.5 - lo * 0.5
                    b = F.floor((F.col("v") * 0.5 - F.lit(lo * 0.5)) / F.lit(width)
                                * F.lit(bins)).cast("int") if width > 0 else F.lit(0)
                    b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1))
                else:
                    b = count_below(F.col("v"), _bit_steps(lo, hi, 63), inclusive=True)
                val = F.struct(F.lit(key).alias("key"), b.alias("b"))
                bucket = F.when(inside, val) if bucket is None else bucket.when(inside, val)
            tagged = narrowed(split.values()).where(cond).select(bucket.alias("kb"), "v")
            agg = (tagged.groupBy(F.col("kb.key").alias("key"), F.col("kb.b").alias("b"))
                         .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                              F.max("v").alias("hi")).collect())
            per_key: dict[int, list] = {}
            for row in agg:
                per_key.setdefault(int(row["key"]), []).append(row)
            new_keys: dict[tuple[int, int], int] = {}
            for ck, (key, r) in list(ranks.items()):
                if key not in split:
                    continue
                c = split[key][0]
                acc = 0
                for row in sorted(per_key[key], key=lambda x: x["b"]):
                    if r < acc + row["n"]:
                        nk = new_keys.get((key, row["b"]))
                        if nk is None:
                            nk = max(brackets) + 1
                            new_keys[(key, row["b"])] = nk
                            brackets[nk] = (c, float(row["lo"]), float(row["hi"]), int(row["n"]))
                        ranks[ck] = (nk, r - acc)
                        break
                    acc += row["n"]

    out: dict[str, list[float | None]] = {}
    for c in cols:
        st = stats.get(c)
        if st is None or st["n"] == 0:
            out[c] = [None for _ in probs]
            continue
        vals = []
        for p in probs:
            h = (st["n"] - 1) * float(p)
            lo_k, hi_k = int(math.floor(h)), int(math.ceil(h))
            a, b = wanted[(c, lo_k)], wanted[(c, hi_k)]
            vals.append(a if a == b or h == lo_k else a + (h - lo_k) * (b - a))
        out[c] = vals
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], **kw) -> list[float | None]:
    """Exact quantiles of one column (see :func:`column_quantiles`)."""
    return column_quantiles(df, [col], probs, **kw)[col]
