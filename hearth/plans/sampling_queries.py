"""Queries for top-k, shuffles, splits, samples and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators import features, sampling
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 111
_DRAW = mix_unit_sql("c_custkey", SEED)
_ODRAW = mix_unit_sql("o_orderkey", SEED)
_W = 0.9 / (0.9 + 0.2)


@query("topk_price", "G2", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def topk_price(spark, d):
    """Ten most expensive orders, ties by key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sampling.top_k(o, "o_totalprice", 10, id_col="o_orderkey")


@query("extremes_20", "G3,E5", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders),
z AS (SELECT o_orderkey, (o_totalprice - m) / sd AS z FROM orders, s)
SELECT o_orderkey, round(z, 8) AS z, 'low' AS side FROM (SELECT * FROM z ORDER BY z, o_orderkey LIMIT 20)
UNION ALL
SELECT o_orderkey, round(z, 8) AS z, 'high' AS side FROM (SELECT * FROM z ORDER BY z DESC, o_orderkey LIMIT 20)
""")
def extremes_20(spark, d):
    """The 20 lowest and 20 highest standardised prices."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    z = features.zscore(o, ["o_totalprice"], ddof=0).select(
        "o_orderkey", F.col("o_totalprice").alias("z"))
    return sampling.extremes(z, "z", 20, "o_orderkey").withColumn("z", F.round("z", 8))


@query("shuffle", "G5", f"""
SELECT c_custkey, row_number() OVER (ORDER BY {_DRAW}, c_custkey)::BIGINT AS shuffle_pos
FROM customer
""")
def shuffle(spark, d):
    """A seeded random permutation with each row's position."""
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.shuffle_rows(c, "c_custkey", SEED, draw=mix_unit("c_custkey", SEED))


@query("shuffle_positions", "G5")
def shuffle_positions(spark, d):
    """A place in a seeded permutation for every line item, by a keyed bijection
    of the rows' positions in the files: no sort, no shuffle."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return sampling.shuffle_positions(l, SEED)


@query("split_weighted", "H1", f"""
SELECT c_custkey, CASE WHEN {_DRAW} < {_W!r} THEN 0 ELSE 1 END AS split FROM customer
""")
def split_weighted(spark, d):
    """Weights 0.9 / 0.2 normalised to 81.8% / 18.2%."""
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.split_label(c, [0.9, 0.2], "c_custkey", SEED,
                                draw=mix_unit("c_custkey", SEED))


@query("sample_exact", "H2", f"""
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY {_DRAW}, c_custkey) AS rk,
                  count(*) OVER () AS n FROM customer)
SELECT c_custkey, rk <= floor(0.75 * n) AS in_sample FROM r
""")
def sample_exact(spark, d):
    """Exactly floor(0.75 n) customers in the sample, the rest flagged out."""
    c = table(spark, d, "customer").select("c_custkey")
    return sampling.exact_sample(c, 0.75, "c_custkey", SEED, draw=mix_unit("c_custkey", SEED))


@query("fold_sizes", "H3", f"""
SELECT least(floor({_ODRAW} * 5)::INTEGER, 4) AS fold, count(*) AS n FROM orders GROUP BY 1
""")
def fold_sizes(spark, d):
    """Rows per fold of a seeded 5-fold assignment."""
    o = table(spark, d, "orders").select("o_orderkey")
    f = sampling.fold_column(o, 5, "o_orderkey", SEED, draw=mix_unit("o_orderkey", SEED))
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
