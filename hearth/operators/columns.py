"""Projections and table introspection."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from hearth.functions.scalar import ratio


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop named columns; names that do not exist are ignored (B1, B2)."""
    return df.drop(*list(names))


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Column subset by list."""
    return df.select(*list(names))


def rename_positional(df: DataFrame, columns: Iterable[str],
                      new_names: Iterable[str]) -> DataFrame:
    """Project and rename by position, e.g. (Id, features, SalePrice) ->
    (Id, features, label) (B4)."""
    return df.select(*list(columns)).toDF(*list(new_names))


def first_column(df: DataFrame) -> DataFrame:
    """First column by position."""
    return df.select(df.columns[0])


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]],
               drop: Iterable[str] = ()) -> DataFrame:
    """Ratio columns (null on a zero denominator) replacing totals."""
    out = df.withColumns({name: ratio(num, den) for name, (num, den) in ratios.items()})
    return out.drop(*list(drop))


def rescale_columns(df: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """In-place constant rescale, x / factor."""
    return df.withColumns({c: F.col(c) / F.lit(float(f)) for c, f in factors.items()})


def columns_of_kind(df: DataFrame, kind: str, exclude: Iterable[str] = ()) -> list[str]:
    """Names of string or numeric columns in schema order, minus ``exclude``.

    Reads only the schema (no job).
    """
    skip = set(exclude)
    want = {"string": StringType, "numeric": NumericType}[kind]
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, want) and f.name not in skip]


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Type casts, e.g. boolean -> double, int -> string."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def replace_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(exprs))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: (column, type, position, row_count).

    The row count is a single global count; the schema part is constant
    per column and attached with one ``explode`` of a literal array.
    """
    meta = F.array(*[F.struct(F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(i + 1).alias("position"))
                     for i, f in enumerate(df.schema.fields)])
    return (df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.explode(meta).alias("m"), "row_count")
              .select("m.column", "m.type", "m.position", "row_count"))


def head_rows(df: DataFrame, n: int, order: Iterable[Column | str]) -> DataFrame:
    """First ``n`` rows under an explicit order (G4): a top-k, so each
    partition keeps only n rows before the merge."""
    return df.orderBy(*list(order)).limit(int(n))
