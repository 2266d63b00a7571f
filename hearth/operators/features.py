"""Feature transforms (E1-E15): scaling, buckets, crosses, indexes, vectors."""

from __future__ import annotations

import math
from typing import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from hearth.functions.scalar import count_below, log1p, mix_unit, mix_unit_sql
from hearth.operators.ranking import column_quantiles, global_rank


def log1p_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """In-place ln(1 + x) on label/area columns."""
    return df.withColumns({c: log1p(c) for c in cols})


def zscore_stats(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation per column in one aggregate.

    ``ddof=1`` is the sample deviation (pandas ``std``), ``ddof=0`` the
    population one (scikit-learn's StandardScaler).
    """
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[sd(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def zscore(df: DataFrame, cols: Sequence[str], *, ddof: int = 1,
           stats: Mapping[str, tuple[float, float]] | None = None,
           suffix: str = "") -> DataFrame:
    """(x - mean) / std per column.

    By default each frame is scaled by its own statistics (the notebooks'
    behaviour); pass the training frame's ``stats`` to scale a test frame
    consistently. A zero or undefined deviation gives null.
    """
    stats = stats or zscore_stats(df, cols, ddof)
    return df.withColumns({
        f"{c}{suffix}": F.try_divide(F.col(c) - F.lit(stats[c][0]),
                                     F.lit(stats[c][1]).cast("double"))
        for c in cols})


def regular_boundaries(df: DataFrame, col: str, step: float) -> list[float]:
    """``arange(int(min), int(max), step)``.

    ``int`` truncates toward zero and the stop is excluded: min -124.35,
    max -114.31, step 1 gives -124 ... -115. Bounded by the range / step.
    """
    return regular_boundaries_many(df, {col: step})[col]


def regular_boundaries_many(df: DataFrame, steps: Mapping[str, float]) -> dict[str, list[float]]:
    """:func:`regular_boundaries` for several columns from one aggregate."""
    if any(step <= 0 for step in steps.values()):
        raise ValueError("step must be positive")
    cols = list(steps)
    row = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        out[c] = boundaries_between(row[f"lo{i}"], row[f"hi{i}"], steps[c])
    return out


def boundaries_between(lo: float | None, hi: float | None, step: float) -> list[float]:
    """``arange(int(lo), int(hi), step)`` for known extremes (E6); empty for none."""
    if step <= 0:
        raise ValueError("step must be positive")
    if lo is None:
        return []
    start, stop = math.trunc(lo), math.trunc(hi)
    return [start + k * step for k in range(max(0, math.ceil((stop - start) / step)))]


def bucket_index(c: Column | str, boundaries: Sequence[float]) -> Column:
    """Bucket id: 0 = (-inf, b0), i = [b(i-1), b(i)), last = [bn, +inf).

    Counts the boundaries <= x, so it is left-closed; null stays null.
    """
    return count_below(c, sorted(boundaries), inclusive=True)


def bucketize(df: DataFrame, col: str, boundaries: Sequence[float], out: str) -> DataFrame:
    return df.withColumn(out, bucket_index(col, boundaries))


def cross_cell(b1: Column | str, b2: Column | str, n2: int) -> Column:
    """Exact grid cell of two bucket ids: b1 * n2 + b2 (E8, exact variant)."""
    b1 = F.col(b1) if isinstance(b1, str) else b1
    b2 = F.col(b2) if isinstance(b2, str) else b2
    return b1 * F.lit(int(n2)) + b2


def hashed_cross(b1: Column | str, b2: Column | str, bins: int = 100, seed: int = 0) -> Column:
    """Hashed feature cross into ``bins`` buckets (E8, hash variant).

    An integer mix of the two bucket ids (see ``mix_unit``), so any engine
    can reproduce the bins. Ids are at least 0; null ids give a null bin."""
    b1 = F.col(b1) if isinstance(b1, str) else b1
    b2 = F.col(b2) if isinstance(b2, str) else b2
    key = F.shiftleft(b1.cast("long"), 31) + b2.cast("long")
    return F.floor(mix_unit(key, seed) * F.lit(int(bins))).cast("int")


def hashed_cross_sql(b1_sql: str, b2_sql: str, bins: int = 100, seed: int = 0) -> str:
    """SQL text (DuckDB dialect) of :func:`hashed_cross`."""
    key = f"({b1_sql})::BIGINT * {1 << 31} + ({b2_sql})::BIGINT"
    return f"floor({mix_unit_sql(key, seed)} * {int(bins)})::INTEGER"


def indicator(df: DataFrame, cols: Sequence[str], sizes: Sequence[int],
              outs: Sequence[str]) -> DataFrame:
    """One-hot sparse vectors of fixed widths for integer ids.

    The width comes from the bucket boundaries, not from the data, so the
    encoder's metadata is fitted on one row holding the largest id of each
    column; the transform itself is Spark ML's JVM-side encoder and keeps
    a single non-zero per vector.
    """
    spark = df.sparkSession
    top = spark.createDataFrame([tuple(float(n - 1) for n in sizes)],
                                ", ".join(f"`{c}` double" for c in cols))
    enc = OneHotEncoder(inputCols=list(cols), outputCols=list(outs), dropLast=False,
                        handleInvalid="error").fit(top)
    return enc.transform(df)


def check_levels(df: DataFrame, cols: Sequence[str], max_levels: int) -> None:
    """Raise ValueError if a column has more than about ``max_levels`` distinct
    values, counted by one scan's sketches: the indexer's domains and the trees'
    bins are held by the driver. :func:`level_codes` has no such bound."""
    if not cols:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first().asDict()
    wide = {c: n for c, n in counts.items() if n > max_levels}
    if wide:
        raise ValueError(f"more than {max_levels} levels: {wide}; number them with level_codes")


def string_indexer(cols: Sequence[str], *, handle_invalid: str = "keep",
                   suffix: str = "_Index") -> StringIndexer:
    """One multi-column indexer: most frequent = 0, ties alphabetical."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def string_index(df: DataFrame, cols: Sequence[str], *, handle_invalid: str = "keep",
                 na_as_level: bool = False, drop_source: bool = True) -> tuple[DataFrame, object]:
    """Fit the indexer on ``df`` and replace each column by ``<col>_Index``.

    ``na_as_level`` folds null into the literal level ``NA`` first, so both
    read modes index the same way. Returns (indexed frame, fitted model) so
    a test frame can reuse the training codes.
    """
    if na_as_level:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit("NA")) for c in cols})
    model = string_indexer(cols, handle_invalid=handle_invalid).fit(df)
    out = model.transform(df)
    return (out.drop(*cols) if drop_source else out), model


def level_codes(df: DataFrame, col: str, code_col: str | None = None) -> DataFrame:
    """(``col``, code) per distinct non-null value: most frequent = 0, ties
    alphabetical, like :func:`string_indexer` (E12), but with no bound on the
    number of values: they are counted by a grouped aggregate and numbered by
    a distributed rank, never gathered in one task or on the driver."""
    code_col = code_col or f"{col}_Index"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    ranked, _ = global_rank(counts, [F.desc("_n"), F.asc(col)], rank_col="_r")
    return ranked.select(col, (F.col("_r") - 1).cast("double").alias(code_col))


def apply_level_codes(df: DataFrame, codes: DataFrame, col: str, *, drop_source: bool = True) -> DataFrame:
    """Replace ``col`` by its code from :func:`level_codes`; null for a null or
    unseen value. An equi-join: the planner broadcasts the codes when it
    measures them under its threshold, and otherwise AQE splits a hot value."""
    out = df.join(codes, col, "left")
    return out.drop(col) if drop_source else out


def one_hot_long(df: DataFrame, id_cols: Sequence[str], col: str) -> DataFrame:
    """One-hot encoding in long form (C11): (ids, ``level``, ``code``) with one
    row per row of ``df``, the position of its single 1. The width has no
    bound, unlike ``clean.one_hot_columns``, which makes one column per value.
    Null values have no 1 and give null ``level`` and ``code``."""
    src = df.select(*id_cols, F.col(col).alias("level"))
    codes = level_codes(src, "level", "code")
    return src.join(codes.withColumn("code", F.col("code").cast("long")), "level", "left").select(*id_cols, "level", "code")


def quantile_label(df: DataFrame, col: str, q: float = 0.75, out: str | None = None,
                   threshold: float | None = None) -> DataFrame:
    """Binary label 1.0 if x > quantile(q) else 0.0."""
    t = threshold if threshold is not None else column_quantiles(df, [col], [q])[col][0]
    return df.withColumn(out or f"{col}_is_high", (F.col(col) > F.lit(t)).cast("double"))


def assembler(cols: Sequence[str], out: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Feature vector in the given column order."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(cols, out, handle_invalid).transform(df)


def feature_preview(model: PipelineModel, df: DataFrame, n: int = 5,
                    order: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """First ``n`` transformed feature rows."""
    out = model.transform(df).select(*keep, "features")
    return out.orderBy(*order).limit(n) if order else out.limit(n)
