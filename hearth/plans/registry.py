"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB oracle over the same tables; None marks a query
    whose result is not expressible in SQL (model fits, hash draws).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
