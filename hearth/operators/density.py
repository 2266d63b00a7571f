"""Gaussian kernel sums on an even grid by a fast Gauss transform.

The rows' kernels are expanded about the centres of boxes one bandwidth wide:
with t = (x - c) / (sqrt(2) h) and u = (g - c) / (sqrt(2) h),
exp(-(u - t)^2) is the sum over j of t^j / j! times the Hermite function
H_j(u) exp(-u^2). A row adds its powers of t to its box, one partial aggregate
over few groups; grid points are then evaluated from the boxes alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: a kernel is taken as 0 beyond so many bandwidths
REACH = 8.6


def error_bound(terms: int) -> float:
    """The most by which one row's kernel (1 at its centre) is wrong: the rest
    of the expansion by Cramér's bound at |t| sqrt(2) <= 1/2, and the kernel
    where it is cut off."""
    rest = sum(0.5 ** j / math.sqrt(math.factorial(j)) for j in range(terms, terms + 40))
    return 1.09 * rest + math.exp(-0.5 * (REACH - 0.5) ** 2)


def gauss_sums(df: DataFrame, col: str, lo: float, step: float, n_points: int, h: float,
               terms: int = 18) -> DataFrame:
    """(point, total): at lo + point * step the sum over the rows of
    exp(-((x - g) / h)^2 / 2), each row within :func:`error_bound` of its kernel.

    One scan. Rows out of every grid point's reach are left out, so there are
    at most about 19 boxes a grid point for any data. A box goes to the points
    in its reach, at most ``n_points``. Nulls and NaNs add nothing.
    """
    x = F.col(col).cast("double")
    near = F.least(F.greatest(F.round((x - F.lit(lo)) / F.lit(step)), F.lit(0.0)), F.lit(float(n_points - 1)))
    in_reach = F.abs(x - (F.lit(lo) + near * F.lit(step))) <= F.lit(REACH * h)
    scale = 1.0 / (math.sqrt(2.0) * h)
    box = F.floor((F.col("x") - F.lit(lo)) / F.lit(h))
    t = (F.col("x") - (F.lit(lo) + (F.col("box") + 0.5) * F.lit(h))) * F.lit(scale)
    power, sums = F.lit(1.0), []
    for j in range(terms):
        sums.append(F.sum(power) * F.lit(1.0 / math.factorial(j)))
        power = power * F.col("t")
    boxes = (df.where(x.isNotNull() & ~F.isnan(x) & in_reach).select(x.alias("x"))
             .withColumn("box", box).withColumn("t", t)
             .groupBy("box").agg(*[s.alias(f"m{j}") for j, s in enumerate(sums)])
             .select((F.lit(lo) + (F.col("box") + 0.5) * F.lit(h)).alias("centre"),
                     F.array(*[F.col(f"m{j}") for j in range(terms)]).alias("m")))
    ends = [(F.col("centre") + F.lit(s * REACH * h) - F.lit(lo)) / F.lit(step) for s in (-1, 1)]
    reached = boxes.withColumn("first", F.greatest(F.ceil(ends[0]), F.lit(0))).withColumn(
        "last", F.least(F.floor(ends[1]), F.lit(n_points - 1))).where("first <= last")
    pairs = reached.select("centre", "m", F.explode(F.sequence(F.col("first").cast("int"), F.col("last").cast("int"))).alias("point"))
    u = (F.lit(lo) + F.col("point") * F.lit(step) - F.col("centre")) * F.lit(scale)
    pairs = pairs.withColumn("u", u)
    # H_0 = 1, H_1 = 2u, H_(j+1) = 2u H_j - 2j H_(j-1)
    start = F.struct(F.lit(0.0).alias("before"), F.exp(-F.col("u") * F.col("u")).alias("now"), F.lit(0.0).alias("total"))

    def add(s, j):
        return F.struct(s["now"].alias("before"), (2.0 * F.col("u") * s["now"] - 2.0 * j * s["before"]).alias("now"),
                        (s["total"] + F.get("m", j) * s["now"]).alias("total"))
    value = F.aggregate(F.sequence(F.lit(0), F.lit(terms - 1)), start, add, lambda s: s["total"])
    grid = df.sparkSession.range(n_points).select(F.col("id").cast("int").alias("point"))
    found = pairs.groupBy("point").agg(F.sum(value).alias("total"))
    return grid.join(found, "point", "left").select("point", F.coalesce("total", F.lit(0.0)).alias("total"))
