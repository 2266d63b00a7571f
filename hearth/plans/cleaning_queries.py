"""Queries for projections, filters and missing-data handling (B, C, G1, G4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import clean, columns, sampling
from hearth.plans.common import (CUSTOMER_WITH_GAPS_SQL, ORDERS_WITH_MARKER_SQL,
                                 PART_WITH_GAPS_SQL, customer_with_gaps,
                                 orders_with_marker, part_with_gaps)
from hearth.plans.registry import query
from hearth.sources.tables import table


@query("filter_missing_marker", "C1,C2", f"""
WITH {ORDERS_WITH_MARKER_SQL.strip()},
top2 AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders_marked
WHERE o_orderpriority <> 'NA'
  AND o_orderkey NOT IN (SELECT o_orderkey FROM top2)
""")
def filter_missing_marker(spark, d):
    """Drop rows holding the ``NA`` marker, then exclude the two most
    expensive orders (the hand-picked outliers of the reference)."""
    o = orders_with_marker(spark, d)
    kept = clean.drop_missing_marker(o, "o_orderpriority")
    outliers = sampling.top_k(table(spark, d, "orders"), "o_totalprice", 2, id_col="o_orderkey")
    return clean.exclude_ids(kept, "o_orderkey", outliers)


@query("exclude_listed_ids", "C2", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (524, 1299)
""")
def exclude_listed_ids(spark, d):
    """Literal id list exclusion, pushed into the Parquet scan as NOT IN."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return clean.exclude_ids(c, "c_custkey", [1299, 524])


@query("drop_and_ratio", "B1,B6,B7", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice / 1000.0 AS l_extendedprice, l_discount,
       CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price
FROM lineitem
""")
def drop_and_ratio(spark, d):
    """Drop a list of columns (one of them absent), add a ratio column and
    rescale the price to thousands."""
    l = table(spark, d, "lineitem")
    out = columns.drop_columns(l, ["l_shipdate", "l_comment", "l_returnflag",
                                   "l_linestatus", "l_tax"])
    out = columns.add_ratios(out, {"unit_price": ("l_extendedprice", "l_quantity")})
    return columns.rescale_columns(out, {"l_extendedprice": 1000.0})


_MISSING_UNPIVOT = """
counts AS (
  SELECT count(*) AS n_rows,
         count_if(p_partkey IS NULL) AS p_partkey, count_if(p_name IS NULL) AS p_name,
         count_if(p_brand IS NULL) AS p_brand, count_if(p_type IS NULL) AS p_type,
         count_if(p_size IS NULL) AS p_size,
         count_if(p_retailprice IS NULL OR isnan(p_retailprice)) AS p_retailprice
  FROM part_with_gaps),
report AS (
  SELECT feature, total, total * 100.0 / n_rows AS percent
  FROM counts UNPIVOT (total FOR feature IN
       (p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)))"""


@query("missing_report", "C4,C5,G1", f"""
WITH {PART_WITH_GAPS_SQL.strip()},{_MISSING_UNPIVOT}
SELECT feature, total::BIGINT AS total, round(percent, 6) AS percent
FROM report WHERE total <> 0 AND percent <> 0
""")
def missing_report(spark, d):
    """Per column null count and percent of rows, non-zero rows only,
    sorted by count descending."""
    rep = clean.missing_report(part_with_gaps(spark, d))
    return rep.withColumn("percent", F.round("percent", 6))


@query("missing_sorted", "C5,G1", f"""
WITH {PART_WITH_GAPS_SQL.strip()},{_MISSING_UNPIVOT}
SELECT feature, total::BIGINT AS total, round(percent, 6) AS percent FROM report
""")
def missing_sorted(spark, d):
    """The full missing report, complete columns included, sorted by count
    descending (range-partitioned sort of the per-column rows)."""
    rep = clean.missing_report(part_with_gaps(spark, d), nonzero_only=False)
    return rep.withColumn("percent", F.round("percent", 6))


@query("prune_sparse_columns", "C6", f"""
WITH {PART_WITH_GAPS_SQL.strip()},{_MISSING_UNPIVOT}
SELECT feature, total::BIGINT AS total, round(percent, 6) AS percent
FROM report WHERE percent <= 15
""")
def prune_sparse_columns(spark, d):
    """Drop every column with more than 15% of its values missing; report
    the surviving columns with their missing counts."""
    kept = clean.drop_sparse_columns(part_with_gaps(spark, d), 15.0)
    rep = clean.missing_report(kept, nonzero_only=False)
    return rep.withColumn("percent", F.round("percent", 6))


@query("missing_groups", "C7", f"""
WITH {PART_WITH_GAPS_SQL.strip()},{_MISSING_UNPIVOT}
SELECT total::BIGINT AS total, count(*) AS n_features,
       string_agg(feature, ',' ORDER BY feature) AS features
FROM report WHERE total <> 0 GROUP BY total
""")
def missing_groups(spark, d):
    """Columns that share the same missing count (one block of fields)."""
    return clean.missing_groups(clean.missing_report(part_with_gaps(spark, d)))


_GAP_COLS = ("p_name", "p_brand", "p_type", "p_retailprice")
_TOGETHER_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{a}' AS feature_x, '{b}' AS feature_y, count(*) FILTER ({a} IS NULL AND {b} IS NULL) AS "both",
       count(*) FILTER ({a} IS NULL AND {b} IS NOT NULL) AS only_x,
       count(*) FILTER ({b} IS NULL AND {a} IS NOT NULL) AS only_y FROM part_with_gaps"""
    for i, a in enumerate(sorted(_GAP_COLS)) for b in sorted(_GAP_COLS)[i + 1:])


@query("missing_together", "C7", f"""
WITH {PART_WITH_GAPS_SQL.strip()},
p AS ({_TOGETHER_SQL})
SELECT *, only_x = 0 AND only_y = 0 AS same_rows FROM p WHERE "both" > 0
""")
def missing_together(spark, d):
    """For every two columns with gaps, how many rows lack both or one of them."""
    return clean.missing_together(clean.missing_patterns(part_with_gaps(spark, d)))


@query("outlier_rule", "C8", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice
FROM lineitem WHERE l_quantity > 48 AND l_extendedprice < 50000
""")
def outlier_rule(spark, d):
    """Large quantity but low price (threshold form of the rule)."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                           "l_extendedprice")
    return clean.outlier_rows(l, "l_quantity", "l_extendedprice", x_above=48, y_below=50000)


@query("outlier_topk", "C8,G2", """
SELECT * FROM (SELECT p_partkey, p_size, p_retailprice FROM part
               ORDER BY p_size DESC, p_partkey LIMIT 20)
WHERE p_retailprice < 950
""")
def outlier_topk(spark, d):
    """Among the 20 largest parts (ties by key), those priced under 950."""
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return clean.outlier_rows(p, "p_size", "p_retailprice", top_k=20, y_below=950,
                              id_col="p_partkey")


@query("zero_ids", "C3,F20", """
SELECT l_orderkey FROM lineitem WHERE l_discount = 0
""")
def zero_ids(spark, d):
    """First column of the rows whose discount is exactly zero."""
    l = table(spark, d, "lineitem")
    return columns.first_column(l.filter(F.col("l_discount") == 0))


@query("impute_median", "C9,F3", f"""
WITH {CUSTOMER_WITH_GAPS_SQL.strip()},
med AS (SELECT quantile_cont(c_acctbal, 0.5) AS m FROM customer_gaps)
SELECT c_custkey, c_mktsegment, coalesce(c_acctbal, (SELECT m FROM med)) AS c_acctbal
FROM customer_gaps
""")
def impute_median(spark, d):
    """Replace missing balances by the exact median of the known ones."""
    c = customer_with_gaps(spark, d).select("c_custkey", "c_mktsegment", "c_acctbal")
    return clean.impute_median(c, ["c_acctbal"])


@query("category_domain", "C10", """
SELECT DISTINCT c_mktsegment FROM customer
""")
def category_domain(spark, d):
    return clean.category_domain(table(spark, d, "customer"), "c_mktsegment")


@query("one_hot", "C11", """
SELECT c_custkey, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS AUTOMOBILE,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS BUILDING,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS FURNITURE,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS HOUSEHOLD,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS MACHINERY
FROM customer
""")
def one_hot(spark, d):
    """One 0/1 column per market segment, source column dropped."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                           "c_mktsegment")
    return clean.one_hot_columns(c, "c_mktsegment")


@query("column_ops", "B2,B3,B4,B5,B8,B9,B10,E10,E14", """
SELECT p_partkey AS id, p_size::DOUBLE AS size, p_retailprice AS price,
       round(sqrt(p_retailprice), 9) AS sqrt_price, abs(p_size - 25) AS size_dev,
       p_size > 25 AS is_large
FROM part
""")
def column_ops(spark, d):
    """Drop by name, keep numeric columns by type, rename by position, cast,
    and add sqrt/abs columns."""
    p = columns.drop_columns(table(spark, d, "part"), ["p_name"])
    nums = columns.columns_of_kind(p, "numeric")
    out = columns.rename_positional(p, nums, ["id", "size", "price"])
    out = columns.replace_columns(out, {
        "sqrt_price": F.round(F.sqrt("price"), 9),
        "size_dev": F.abs(F.col("size") - 25),
        "is_large": F.col("size") > 25})
    return columns.cast_columns(out, {"size": "double"})


@query("schema_profile", "B11", """
SELECT m.column_name AS "column", m.type, m.position, (SELECT count(*) FROM part) AS row_count
FROM (VALUES ('p_partkey', 'bigint', 1), ('p_name', 'string', 2), ('p_brand', 'string', 3),
             ('p_type', 'string', 4), ('p_size', 'int', 5), ('p_retailprice', 'double', 6))
     AS m(column_name, type, position)
""")
def schema_profile(spark, d):
    """Column names, types and positions with the row count."""
    return columns.schema_profile(table(spark, d, "part"))


@query("sorted_desc", "G1", """
SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position
FROM customer
""")
def sorted_desc(spark, d):
    """All customers by balance, descending (range-partitioned sort)."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return sampling.sort_desc(c, "c_acctbal", tie="c_custkey", position="position")


@query("first_rows", "G4", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 6
""")
def first_rows(spark, d):
    """The first six orders by key (a deterministic ``head``)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice")
    return columns.head_rows(o, 6, ["o_orderkey"])
