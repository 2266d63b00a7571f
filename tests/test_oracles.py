"""Every SQL-expressible registered query equals its DuckDB oracle
(row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

from tests.conftest import SF001
import __spark_entry__ as E
from hearth.sources.tables import TABLES

ORACLES = E.oracle_sql()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x)
        return "<null>" if x is None else str(x)
    return sorted(tuple(v(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _norm(srows, df.columns) == _norm(drows, dcols)
    # column types agree too (the schema part of the comparison)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    for f in df.schema.fields:
        spark_type = f.dataType.simpleString()
        assert _TYPES.get(spark_type, spark_type) == dtypes[f.name], (f.name, spark_type)


def test_every_query_registered_with_ids():
    from hearth.plans import SURVEY_IDS
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    from hearth.plans import QUERIES
    assert set(QUERIES) <= set(qs) and all(SURVEY_IDS[n] for n in QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "predicted_price"]
    assert df.count() > 0
