"""Queries over the sources and sinks (A1-A5, C1): a CSV round trip in the
shared folder, read back in both missing-marker modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import clean
from hearth.plans.common import CUSTOMER_WITH_GAPS_SQL, customer_with_gaps
from hearth.plans.registry import query
from hearth.session import drop_at_exit, shared_folder
from hearth.sources.csv import NA_TOKEN, read_csv
from hearth.sources.sinks import write_predictions

_SCHEMA = "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"


def _csv_copy(spark, d) -> str:
    """Write the customer table with ``NA`` for missing balances as headed
    CSV under the shared checkpoint folder (written by the executors)."""
    path = shared_folder(spark, "customer_csv")
    src = customer_with_gaps(spark, d).select("c_custkey", "c_nationkey", "c_mktsegment",
                                             "c_acctbal")
    src.write.mode("overwrite").option("header", True).option("nullValue", NA_TOKEN).csv(path)
    return path


@query("csv_na_modes", "A1,A2,A4,A5,C1", f"""
WITH {CUSTOMER_WITH_GAPS_SQL.strip()}
SELECT c_custkey, c_mktsegment, c_acctbal AS acctbal_literal, c_acctbal AS acctbal_null
FROM customer_gaps WHERE c_acctbal IS NOT NULL
""")
def csv_na_modes(spark, d):
    """Read the CSV copy twice: with ``NA`` kept as a literal (inferred
    types make the balance a string) and with ``NA`` as null (explicit
    schema, no inference job). Dropping the marker rows gives the same
    customers in both modes; their balances agree."""
    path = _csv_copy(spark, d)
    lit = clean.drop_missing_marker(read_csv(spark, path, na_mode="literal"), "c_acctbal")
    nul = clean.drop_missing_marker(read_csv(spark, path, na_mode="null", schema=_SCHEMA),
                                    "c_acctbal")
    lit = lit.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment",
                     F.col("c_acctbal").cast("double").alias("acctbal_literal"))
    nul = nul.select("c_custkey", F.col("c_acctbal").alias("acctbal_null"))
    return lit.join(nul, "c_custkey")


@query("prediction_sink", "A5,A7", """
SELECT o_orderkey AS Id, o_totalprice AS SalePrice FROM orders
""")
def prediction_sink(spark, d):
    """Write a complete prediction table (all rows, by the executors) in
    submission layout and read it back."""
    path = shared_folder(spark, "submission")
    o = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    pred = o.select(F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("SalePrice"))
    write_predictions(pred, path, fmt="csv")
    return read_csv(spark, path, schema="Id long, SalePrice double")


@query("colocated_join", "A4,A5,I1", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_brand, p.p_size
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""")
def colocated_join(spark, d):
    """The modelling join over copies of lineitem and part bucketed on the
    part key in the shared folder: with broadcasting ruled out by size, the
    sort-merge join reads both sides without an exchange."""
    from hearth.sources.sinks import write_bucketed
    from hearth.sources.tables import table
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def bucketed(rows, name, key):
        path = shared_folder(spark, name)
        table_name = path.split("/")[-2]
        drop_at_exit(spark, table_name)
        return write_bucketed(rows, table_name, key, buckets, path)
    l = bucketed(table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "lineitem_by_part", "l_partkey")
    p = bucketed(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), "part_by_part", "p_partkey")
    return l.join(p, l.l_partkey == p.p_partkey).drop("p_partkey")
