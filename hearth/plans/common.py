"""Shared derived frames used by several queries (Spark side and SQL side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearth.sources.tables import table


def part_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """``part`` with missing values injected by value rules (the driver
    tables hold no nulls): names and brands of the largest parts, types of
    the cheapest, prices of the smallest."""
    p = table(spark, d, "part")
    big = F.col("p_size") > 45
    return p.select(
        "p_partkey",
        F.when(~big, F.col("p_name")).alias("p_name"),
        F.when(~big, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_retailprice") >= 905, F.col("p_type")).alias("p_type"),
        "p_size",
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("p_retailprice"))


PART_WITH_GAPS_SQL = """
part_with_gaps AS (
  SELECT p_partkey,
         CASE WHEN p_size > 45 THEN NULL ELSE p_name END AS p_name,
         CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS p_brand,
         CASE WHEN p_retailprice >= 905 THEN p_type ELSE NULL END AS p_type,
         p_size,
         CASE WHEN p_size > 10 THEN p_retailprice ELSE NULL END AS p_retailprice
  FROM part)"""


def orders_with_marker(spark: SparkSession, d: str) -> DataFrame:
    """``orders`` whose priority is the literal missing marker ``NA`` for
    cheap pending orders."""
    o = table(spark, d, "orders")
    marked = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000)
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.when(marked, F.lit("NA")).otherwise(F.col("o_orderpriority"))
                     .alias("o_orderpriority"))


ORDERS_WITH_MARKER_SQL = """
orders_marked AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN 'NA'
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""


def customer_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """``customer`` with unreported balances for one market segment."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_nationkey", "c_mktsegment",
                    F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal"))
                     .alias("c_acctbal"))


CUSTOMER_WITH_GAPS_SQL = """
customer_gaps AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal ELSE NULL END AS c_acctbal
  FROM customer)"""


def lineitem_measures(spark: SparkSession, d: str) -> DataFrame:
    """Numeric ``lineitem`` columns plus two derived amounts (revenue and
    charge), which are strongly dependent on the price by construction."""
    l = table(spark, d, "lineitem")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return l.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", rev.alias("revenue"),
                    (rev * (1 + F.col("l_tax"))).alias("charge"))


LINEITEM_MEASURES_SQL = """
measures AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) AS revenue,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
  FROM lineitem)"""

MEASURE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "revenue", "charge")
