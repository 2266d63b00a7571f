"""Trees with exact splits (I2-I4) with their SQL: every level's tables of
counts and sums, the best cut of each node, and the routing, one level a step."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.scalar import mix_unit, mix_unit_sql
from hearth.operators import exact_trees as et
from hearth.plans.registry import query
from hearth.sources.tables import table

SEED = 7
COLS = ["qty", "disc", "tax"]


def line_frame(spark, d):
    """Line items: three numbers, the price in thousands, and the split of their order."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("qty"),
        (F.col("l_discount") * 100).cast("double").alias("disc"), (F.col("l_tax") * 100).cast("double").alias("tax"),
        (F.col("l_extendedprice") / 1000.0).alias("y"), (mix_unit("l_orderkey", SEED) < 0.8).alias("is_train"))


_ROWS = f"""
li AS (SELECT row_number() OVER () AS row_no, l_orderkey, l_linenumber, [l_quantity::DOUBLE, (l_discount * 100)::DOUBLE, (l_tax * 100)::DOUBLE] AS x,
              l_extendedprice / 1000.0 AS y, {mix_unit_sql("l_orderkey", SEED)} < 0.8 AS is_train FROM lineitem)"""


def grow_sql(name: str, depth: int, allowed: str = "TRUE") -> str:
    """CTEs that route ``{name}0`` (key columns, tree, node, x, y, w) through the
    levels, ending in ``{name}{depth}``, and its leaves' means, ``{name}_leaf``."""
    out = []
    for k in range(depth):
        r = f"{name}{k}"
        out.append(f"""
{r}_avc AS (SELECT tree, node, f, x[f + 1] AS v, sum(w) AS n, sum(w * y) AS s, sum(w * y * y) AS q
  FROM (SELECT *, unnest(range(len(x))) AS f FROM {r} WHERE w > 0 AND node >= {2 ** k}) WHERE {allowed}
  GROUP BY tree, node, f, x[f + 1]),
{r}_cut AS (SELECT tree, node, f, v, lead(v) OVER w AS nxt, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
    sum(n) OVER a AS nt, sum(s) OVER a AS st, sum(q) OVER a AS qt FROM {r}_avc
  WINDOW w AS (PARTITION BY tree, node, f ORDER BY v), a AS (PARTITION BY tree, node, f)),
{r}_gain AS (SELECT *, round((sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) / qt, 10) AS gain
  FROM {r}_cut WHERE nxt IS NOT NULL),
{r}_best AS (SELECT tree, node, f, (v + nxt) / 2 AS cut FROM {r}_gain WHERE gain > 1e-9
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, v) = 1),
{name}{k + 1} AS (SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.node
    WHEN r.x[b.f + 1] <= b.cut THEN 2 * r.node ELSE 2 * r.node + 1 END AS node)
  FROM {r} r LEFT JOIN {r}_best b ON r.tree = b.tree AND r.node = b.node)""")
    out.append(f"""
{name}_leaf AS (SELECT tree, node, sum(w * y) / sum(w) AS pred FROM {name}{depth} WHERE w > 0 GROUP BY tree, node)""")
    return ",".join(out)


@query("exact_tree", "I2,I8", f"""
WITH {_ROWS.strip()},
t0 AS (SELECT l_orderkey, l_linenumber, 0 AS tree, 1 AS node, x, y, is_train::INTEGER AS w FROM li),{grow_sql("t", 3)}
SELECT l_orderkey, l_linenumber, node::INTEGER AS node, round(pred, 4) AS prediction
FROM t3 JOIN t_leaf USING (tree, node) WHERE w = 0
""")
def exact_tree(spark, d):
    """A tree of depth 3 that tries every cut; leaf and prediction of the held-out rows."""
    frame = line_frame(spark, d)
    tree, = et.fit_exact_trees(frame.filter("is_train"), COLS, "y", 3)
    held = frame.filter("NOT is_train").withColumn("x", F.array(*COLS))
    return held.select("l_orderkey", "l_linenumber", et.node_of(tree, F.col("x")).alias("node"),
                       F.round(et.predicted(tree, F.col("x")), 4).alias("prediction"))


_TREES = 5
_KEY = "l_orderkey * 8 + l_linenumber"
_BAG = " + ".join(f"({mix_unit_sql(f'({_KEY}) * 32 + tree', SEED)} >= {c!r})::INTEGER" for c in et.POISSON_CDF)
_DRAWS = "[" + ", ".join(mix_unit_sql(f"(tree * 65536 + node) * 64 + {f}", SEED) for f in range(len(COLS))) + "]"
_ALLOWED = f"len(list_filter({_DRAWS}, lambda u: u < {mix_unit_sql('(tree * 65536 + node) * 64 + f', SEED)})) < 2"


@query("exact_forest", "I3,I8", f"""
WITH {_ROWS.strip()},
t0 AS (SELECT row_no, l_orderkey, l_linenumber, tree, 1 AS node, x, y, CASE WHEN is_train THEN {_BAG} ELSE 0 END AS w, is_train
       FROM li, (SELECT unnest(range({_TREES})) AS tree)),{grow_sql("t", 3, _ALLOWED)}
SELECT l_orderkey, l_linenumber, round(avg(pred), 4) AS prediction
FROM t3 JOIN t_leaf USING (tree, node) WHERE NOT is_train GROUP BY row_no, l_orderkey, l_linenumber
""")
def exact_forest(spark, d):
    """Five bagged trees of depth 3, two of three features at a node; the mean
    prediction of the held-out rows."""
    frame = line_frame(spark, d)
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    trees = et.fit_exact_trees(frame.filter("is_train"), COLS, "y", 3, n_trees=_TREES, features_per_node=2, seed=SEED,
                               bag_key=key)
    return frame.filter("NOT is_train").select(
        "l_orderkey", "l_linenumber", F.round(et.forest_prediction(trees, COLS), 4).alias("prediction"))


def _boost_sql(rounds: int, depth: int) -> str:
    """Rounds of trees: each one's rows carry the sum so far and the new label."""
    out = []
    for k in range(rounds):
        if k == 0:
            label, carry, source = "y", "y AS target, 0.0::DOUBLE AS total", "li"
        else:
            step = 1.0 if k == 1 else 0.1
            source = f"""(SELECT b.*, b.total + {step} * l.pred AS so_far FROM b{k - 1}x{depth} b
  JOIN b{k - 1}x_leaf l ON b.tree = l.tree AND b.node = l.node)"""
            label, carry = "2 * (target - so_far)", "target, so_far AS total"
        train = "is_train::INTEGER" if k == 0 else "w"
        out.append(f"""
b{k}x0 AS (SELECT l_orderkey, l_linenumber, {k} AS tree, 1 AS node, x, {label} AS y, {train} AS w, {carry}
  FROM {source}),{grow_sql(f"b{k}x", depth)}""")
    return ",".join(out)


@query("exact_boosted", "I4,I8", f"""
WITH {_ROWS.strip()},{_boost_sql(3, 2)}
SELECT l_orderkey, l_linenumber, round(total + 0.1 * pred, 4) AS prediction
FROM b2x2 JOIN b2x_leaf USING (tree, node) WHERE w = 0
""")
def exact_boosted(spark, d):
    """Three boosted trees of depth 2; predictions of the held-out rows."""
    frame = line_frame(spark, d)
    trees = et.fit_exact_boosted(frame.filter("is_train"), COLS, "y", 2, 3, step=0.1)
    return frame.filter("NOT is_train").select(
        "l_orderkey", "l_linenumber", F.round(et.boosted_prediction(trees, COLS, 0.1), 4).alias("prediction"))
