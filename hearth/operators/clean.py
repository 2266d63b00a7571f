"""Missing-data handling, outlier rules and categorical expansion."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from hearth.sources.csv import NA_TOKEN
from hearth.operators.ranking import column_quantiles


def drop_missing_marker(df: DataFrame, col: str, marker: str = NA_TOKEN) -> DataFrame:
    """Drop rows whose ``col`` holds the missing marker.

    ``col != 'NA'`` is also false for null, so the same rows go in both
    read modes (literal ``NA`` or null). A non-string column (a numeric
    column read with ``NA`` as null) cannot hold the marker, so there the
    rule is only "not null".
    """
    if not isinstance(df.schema[col].dataType, StringType):
        return df.filter(F.col(col).isNotNull())
    return df.filter(F.col(col) != F.lit(marker))


def exclude_ids(df: DataFrame, id_col: str, ids: Sequence | DataFrame,
                ids_col: str | None = None) -> DataFrame:
    """Remove rows by id.

    A literal list becomes ``NOT IN`` (pushed to the scan). A DataFrame of
    ids is a ``left_anti`` join: AQE turns it into a broadcast only when the
    measured id side is under the broadcast threshold. Rows without id stay
    in both forms.
    """
    if isinstance(ids, DataFrame):
        key = ids_col or id_col
        right = ids.select(F.col(key).alias("_excl_id"))
        return df.join(right, F.col(id_col) == F.col("_excl_id"), "left_anti")
    return df.filter(F.col(id_col).isNull() | ~F.col(id_col).isin([i for i in ids if i is not None]))


def rows_equal(df: DataFrame, col: str, value, select: Iterable[str]) -> DataFrame:
    """Rows with ``col == value``, projected (C3, e.g. zero-basement ids)."""
    return df.filter(F.col(col) == F.lit(value)).select(*list(select))


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)   # pandas counts NaN as missing
    return col.isNull()


def missing_report(df: DataFrame, cols: Sequence[str] | None = None, *,
                   nonzero_only: bool = True) -> DataFrame:
    """Per column: null count and share of rows in percent, sorted desc.

    One scan: every count is a conditional count in a single aggregate; the
    one result row is unpivoted to (feature, total, percent).
    """
    cols = list(cols or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(_is_missing(df, c)).alias(c) for c in cols])
    long = counts.unpivot("_rows", cols, "feature", "total")
    out = long.select("feature", F.col("total").cast("long").alias("total"),
                      (F.try_divide(F.col("total") * 100.0, F.col("_rows"))).alias("percent"))
    if nonzero_only:
        out = out.filter((F.col("total") != 0) & (F.col("percent") != 0))
    return out.orderBy(F.desc("total"), F.asc("feature"))


def sparse_columns(df: DataFrame, threshold_pct: float = 15.0,
                   cols: Sequence[str] | None = None) -> list[str]:
    """Names of columns with more than ``threshold_pct`` percent missing.

    The collected list is bounded by the column count.
    """
    rep = missing_report(df, cols)
    return [r["feature"] for r in rep.filter(F.col("percent") > threshold_pct).collect()]


def drop_sparse_columns(df: DataFrame, threshold_pct: float = 15.0) -> DataFrame:
    """Drop columns above the missing-share threshold."""
    return df.drop(*sparse_columns(df, threshold_pct))


def missing_groups(report: DataFrame) -> DataFrame:
    """Columns sharing the same missing count, e.g. the Garage* block."""
    return (report.groupBy("total")
                  .agg(F.count(F.lit(1)).alias("n_features"),
                       F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"))
                  .orderBy(F.desc("total")))


def missing_patterns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Which columns are missing together (C7): (features, n_rows), one row per
    set of missing columns that occurs, the empty set included. One scan; a
    row's set is combined with equal ones before the shuffle."""
    cols = list(cols or df.columns)
    # a bit per column, 60 to a number
    words = [sum((F.when(F.col(f"`{c}`").isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(cols[at:at + 60])),
                 F.lit(0).cast("long")) for at in range(0, len(cols), 60)]
    counted = df.groupBy(*[w.alias(f"w{i}") for i, w in enumerate(words)]).agg(F.count(F.lit(1)).alias("n_rows"))
    names = F.array(*[F.when(F.col(f"w{i // 60}").bitwiseAND(F.lit(1 << (i % 60))) != 0, F.lit(c)) for i, c in enumerate(cols)])
    return counted.select(F.array_compact(names).alias("features"), "n_rows")


def missing_together(patterns: DataFrame) -> DataFrame:
    """Of every two columns that have missing values (C7): (feature_x, feature_y,
    both, only_x, only_y, same_rows), from :func:`missing_patterns`. Equal counts
    don't say that the same rows are concerned; ``same_rows`` does. Pairs that
    are never missing together aren't listed."""
    have = patterns.filter(F.size("features") > 0)
    single = have.select(F.explode("features").alias("f"), "n_rows").groupBy("f").agg(F.sum("n_rows").alias("total"))
    pairs = (have.select(F.explode("features").alias("feature_x"), "features", "n_rows")
             .select("feature_x", F.explode("features").alias("feature_y"), "n_rows").filter("feature_x < feature_y")
             .groupBy("feature_x", "feature_y").agg(F.sum("n_rows").alias("both")))
    x = single.select(F.col("f").alias("feature_x"), F.col("total").alias("tx"))
    y = single.select(F.col("f").alias("feature_y"), F.col("total").alias("ty"))
    only_x, only_y = F.col("tx") - F.col("both"), F.col("ty") - F.col("both")
    return pairs.join(x, "feature_x").join(y, "feature_y").select(
        "feature_x", "feature_y", "both", only_x.alias("only_x"), only_y.alias("only_y"),
        ((only_x == 0) & (only_y == 0)).alias("same_rows"))


def outlier_rows(df: DataFrame, x: str, y: str, *, x_above: float | None = None,
                 y_below: float | None = None, top_k: int | None = None,
                 id_col: str | None = None) -> DataFrame:
    """Outlier rule (C8): large ``x`` with small ``y``.

    Either a threshold form (``x > x_above and y < y_below``) or the
    notebook's form: among the ``top_k`` largest ``x`` (ties by id), those
    with ``y < y_below``. The top-k is a per-partition take-ordered, not a
    full sort.
    """
    out = df
    if top_k is not None:
        order = [F.desc(x)] + ([F.asc(id_col)] if id_col else [])
        out = out.orderBy(*order).limit(int(top_k))
    if x_above is not None:
        out = out.filter(F.col(x) > F.lit(x_above))
    if y_below is not None:
        out = out.filter(F.col(y) < F.lit(y_below))
    return out


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact median of the non-null values.

    Medians come from the distributed exact-quantile routine (no single-task
    value map) and are applied as literals.
    """
    med = column_quantiles(df, list(cols), [0.5])
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(med[c][0])) for c in cols
                           if med[c][0] is not None})


def category_domain(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a category."""
    return df.select(col).distinct()


def one_hot_columns(df: DataFrame, col: str, *, max_levels: int = 1000,
                    drop_source: bool = True, prefix: str = "") -> DataFrame:
    """One 0/1 integer column per category value, named by the value (C11).

    The domain is collected to name the columns; it is checked against
    ``max_levels`` so an id-like column cannot explode the schema.
    """
    levels = [r[0] for r in category_domain(df, col).limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    levels = sorted(v for v in levels if v is not None)
    hot = [F.when(F.col(col) == F.lit(v), 1).otherwise(0).alias(f"{prefix}{v}") for v in levels]
    new_names = {f"{prefix}{v}" for v in levels}
    keep = [F.col(c) for c in df.columns
            if c not in new_names and not (drop_source and c == col)]
    return df.select(*keep, *hot)
