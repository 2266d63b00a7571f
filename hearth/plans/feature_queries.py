"""Queries for scalar transforms, scaling, buckets, crosses and indexes (E)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hearth.functions.scalar import expm1, log1p, log_positive
from hearth.operators import features, metrics
from hearth.plans.registry import query
from hearth.sources.tables import table


@query("log1p_expm1", "E1,E2", """
SELECT o_orderkey, round(ln(1 + o_totalprice), 9) AS log_price,
       round(exp(ln(1 + o_totalprice)) - 1, 4) AS price_back
FROM orders
""")
def log1p_expm1(spark, d):
    """ln(1+x) on the price and the e^x-1 round trip."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.round(log1p("o_totalprice"), 9).alias("log_price"),
                    F.round(expm1(log1p("o_totalprice")), 4).alias("price_back"))


@query("log_positive", "E3", """
SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) ELSE c_acctbal END, 9) AS acctbal_log
FROM customer
""")
def log_positive_q(spark, d):
    """Log only where the balance is positive, unchanged elsewhere."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.round(log_positive("c_acctbal"), 9).alias("acctbal_log"))


@query("zscore_sample", "E4,F5", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / sd, 8) AS z FROM orders, s
""")
def zscore_sample(spark, d):
    """(x - mean) / sample std."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    z = features.zscore(o, ["o_totalprice"], ddof=1)
    return z.select("o_orderkey", F.round("o_totalprice", 8).alias("z"))


@query("zscore_pop", "E5", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / sd, 8) AS z FROM orders, s
""")
def zscore_pop(spark, d):
    """(x - mean) / population std (StandardScaler's definition)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    z = features.zscore(o, ["o_totalprice"], ddof=0)
    return z.select("o_orderkey", F.round("o_totalprice", 8).alias("z"))


_PRICE_BOUNDS_SQL = """
b AS (SELECT trunc(min(l_extendedprice)) AS start,
             ceil((trunc(max(l_extendedprice)) - trunc(min(l_extendedprice))) / 10000.0)::INTEGER AS nb
      FROM lineitem)"""

_QTY_BOUNDS_SQL = """
bq AS (SELECT trunc(min(l_quantity)) AS qstart,
              ceil((trunc(max(l_quantity)) - trunc(min(l_quantity))) / 5.0)::INTEGER AS nq
       FROM lineitem)"""


def _bucket_sql(x: str, start: str, step: str, n: str) -> str:
    return (f"(CASE WHEN {x} < {start} THEN 0 "
            f"ELSE least(floor(({x} - {start}) / {step})::INTEGER + 1, {n}) END)")


@query("bucketize", "E6,E7", f"""
WITH {_PRICE_BOUNDS_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_extendedprice,
       {_bucket_sql('l_extendedprice', 'start', '10000.0', 'nb')} AS price_bucket
FROM lineitem, b
""")
def bucketize_q(spark, d):
    """Regular boundaries arange(int(min), int(max), 10000) and the
    left-closed bucket id of each price."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    bounds = features.regular_boundaries(l, "l_extendedprice", 10000.0)
    return features.bucketize(l, "l_extendedprice", bounds, "price_bucket")


def _grid(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                           "l_extendedprice")
    bounds = features.regular_boundaries_many(l, {"l_quantity": 5.0, "l_extendedprice": 10000.0})
    qb, pb = bounds["l_quantity"], bounds["l_extendedprice"]
    g = l.select("l_orderkey", "l_linenumber",
                 features.bucket_index("l_quantity", qb).alias("qty_bucket"),
                 features.bucket_index("l_extendedprice", pb).alias("price_bucket"))
    return g, len(qb) + 1, len(pb) + 1


@query("cross_cell", "E8", f"""
WITH {_PRICE_BOUNDS_SQL.strip()}, {_QTY_BOUNDS_SQL.strip()}
SELECT l_orderkey, l_linenumber, qty_bucket, price_bucket,
       qty_bucket * (nb + 1) + price_bucket AS cell
FROM (SELECT l_orderkey, l_linenumber, nb,
             {_bucket_sql('l_quantity', 'qstart', '5.0', 'nq')} AS qty_bucket,
             {_bucket_sql('l_extendedprice', 'start', '10000.0', 'nb')} AS price_bucket
      FROM lineitem, b, bq)
""")
def cross_cell(spark, d):
    """Exact grid cell of quantity bucket x price bucket."""
    g, _, n2 = _grid(spark, d)
    return g.withColumn("cell", features.cross_cell("qty_bucket", "price_bucket", n2))


@query("hashed_cross", "E8", f"""
WITH {_PRICE_BOUNDS_SQL.strip()}, {_QTY_BOUNDS_SQL.strip()}
SELECT l_orderkey, l_linenumber, qty_bucket, price_bucket,
       {features.hashed_cross_sql('qty_bucket', 'price_bucket', 100)} AS cross_bin
FROM (SELECT l_orderkey, l_linenumber,
             {_bucket_sql('l_quantity', 'qstart', '5.0', 'nq')} AS qty_bucket,
             {_bucket_sql('l_extendedprice', 'start', '10000.0', 'nb')} AS price_bucket
      FROM lineitem, b, bq)
""")
def hashed_cross(spark, d):
    """Hashed cross of the two buckets into 100 bins."""
    g, _, _ = _grid(spark, d)
    return g.withColumn("cross_bin", features.hashed_cross("qty_bucket", "price_bucket", 100))


@query("indicator", "E9", f"""
WITH {_PRICE_BOUNDS_SQL.strip()}, {_QTY_BOUNDS_SQL.strip()}
SELECT l_orderkey, l_linenumber,
       ({_bucket_sql('l_quantity', 'qstart', '5.0', 'nq')}) * (nb + 1)
         + {_bucket_sql('l_extendedprice', 'start', '10000.0', 'nb')} AS hot_index,
       (nq + 1) * (nb + 1) AS width, 1 AS n_hot
FROM lineitem, b, bq
""")
def indicator_q(spark, d):
    """One-hot vector of the grid cell; reported as (hot index, width, non-zeros)."""
    g, n1, n2 = _grid(spark, d)
    g = g.withColumn("cell", features.cross_cell("qty_bucket", "price_bucket", n2))
    v = features.indicator(g, ["cell"], [n1 * n2], ["cell_vec"])
    # the sparse vector's own fields: no dense array per row
    v = v.select("l_orderkey", "l_linenumber", F.unwrap_udt("cell_vec").alias("u"))
    return v.select("l_orderkey", "l_linenumber", F.col("u.indices")[0].cast("int").alias("hot_index"),
                    F.col("u.size").alias("width"), F.size("u.indices").alias("n_hot"))


@query("high_value_label", "E13,F3", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.75) AS t FROM orders)
SELECT o_orderkey, (o_totalprice > t)::DOUBLE AS is_high FROM orders, q
""")
def high_value_label(spark, d):
    """Label 1.0 where the price exceeds its exact 75th percentile."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return features.quantile_label(o, "o_totalprice", 0.75, "is_high").drop("o_totalprice")


@query("majority_baseline", "J8", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.75) AS t FROM orders),
lab AS (SELECT (o_totalprice > t)::DOUBLE AS is_high FROM orders, q),
c AS (SELECT is_high, count(*) AS n FROM lab GROUP BY is_high)
SELECT (SELECT is_high FROM c ORDER BY n DESC, is_high LIMIT 1) AS majority_class,
       round(max(n) / sum(n), 9) AS baseline_accuracy FROM c
""")
def majority_baseline(spark, d):
    """Accuracy of always answering the majority class of the q75 label."""
    lab = high_value_label(spark, d)
    out = metrics.majority_baseline(lab, "is_high")
    return out.withColumn("baseline_accuracy", F.round("baseline_accuracy", 9))


@query("string_index", "E12", """
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
r AS (SELECT p_brand, (row_number() OVER (ORDER BY n DESC, p_brand) - 1)::DOUBLE AS p_brand_Index FROM c)
SELECT p_partkey, p_brand_Index FROM part JOIN r USING (p_brand)
""")
def string_index(spark, d):
    """Brand codes by frequency (most frequent = 0, ties alphabetical)."""
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return features.apply_level_codes(p, features.level_codes(p, "p_brand"), "p_brand")


@query("one_hot_long", "C11", """
WITH c AS (SELECT p_type, count(*) AS n FROM part GROUP BY p_type),
r AS (SELECT p_type, row_number() OVER (ORDER BY n DESC, p_type) - 1 AS code FROM c)
SELECT p_partkey, p_type AS level, code::BIGINT AS code FROM part JOIN r USING (p_type)
""")
def one_hot_long(spark, d):
    """Part types one-hot in long form: the position of each row's 1."""
    return features.one_hot_long(table(spark, d, "part"), ["p_partkey"], "p_type")


@query("feature_block", "E11,E15", """
SELECT o_orderkey, o_totalprice AS f0, o_custkey::DOUBLE AS f1,
       (CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)::DOUBLE AS f2
FROM orders ORDER BY o_orderkey LIMIT 5
""")
def feature_block(spark, d):
    """Assembled feature vectors of the first five orders, one column per slot."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("custkey"),
        (F.col("o_orderstatus") == "F").cast("double").alias("is_final"))
    v = features.assemble(o, ["o_totalprice", "custkey", "is_final"])
    head = v.orderBy("o_orderkey").limit(5)
    a = vector_to_array("features")
    return head.select("o_orderkey", a[0].alias("f0"), a[1].alias("f1"), a[2].alias("f2"))
