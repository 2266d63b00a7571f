"""Merkle manifest of a table (operator 13).

Leaves are digests of rows. Every three consecutive nodes of a tree are hashed
into one until a single node, the tree's root, remains. A table has one tree
for each value of a column, and a last tree over their roots.

A tree is cut into aligned blocks of ``ARITY ** block_levels`` leaves. A block
is one row: its nodes lie in van Emde Boas order in one binary value (a subtree
is split at half height, the upper half is stored first, then the lower
subtrees, each in the same way), so construction and the search for siblings
are arithmetic on places in it. The block roots are the leaves of the next
layer, up to the root; proofs come down the same layers. No task holds more
than one block's group, and the driver only the number of trees and rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hearth.llm.common import stage
from hearth.operators.ranking import global_rank

ARITY = 3
#: levels of hashing in a block: 729 leaves, 1,093 nodes, 35 kB
BLOCK_LEVELS = 6
#: up to so many trees their sizes are joined by broadcast
BROADCAST_TREES = 100_000
HEX = 64


def tree_size(levels: int) -> int:
    """Nodes of a complete tree of so many levels of nodes."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index):
    """Place in van Emde Boas order of a node of a complete tree with ``levels``
    levels of nodes, given its depth (the root's is 0) and number in its level."""
    place = index * 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels -= top
        depth -= top
        below = ARITY ** depth
        place = place + tree_size(top) + index // below * tree_size(levels)
        index = index % below
    return place


@lru_cache(maxsize=None)
def level_addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(ARITY ** depth))


def height(n: int, block_levels: int = BLOCK_LEVELS) -> int:
    """Levels of hashing in a block of a tree with ``n`` leaves."""
    h = 0
    while h < block_levels and ARITY ** h < n:
        h += 1
    return h


def build_block(leaves: list[bytes], h: int) -> bytes:
    """The nodes of a block in van Emde Boas order; places without a node are zero."""
    nodes = np.zeros((tree_size(h + 1), 32), np.uint8)
    level = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    nodes[level_addresses(h + 1, h)[:len(level)]] = level
    for depth in range(h, 0, -1):
        count = -(-len(leaves) // ARITY ** (h - depth))
        text = nodes[level_addresses(h + 1, depth)[:count]].tobytes().hex().encode()
        step = ARITY * HEX
        above = b"".join(hashlib.sha256(text[k:k + step]).digest() for k in range(0, len(text), step))
        level = np.frombuffer(above, np.uint8).reshape(-1, 32)
        nodes[level_addresses(h + 1, depth - 1)[:len(level)]] = level
    return nodes.tobytes()


def siblings(block: bytes, n: int, h: int) -> list[list[tuple[str, str]]]:
    """For each level of a block from the leaves up and each node of it, the
    digests before and after it in its run, as one hex text each."""
    nodes = np.frombuffer(block, np.uint8).reshape(-1, 32)
    out = []
    for depth in range(h, 0, -1):
        count = -(-n // ARITY ** (h - depth))
        text = nodes[level_addresses(h + 1, depth)[:count]].tobytes().hex()
        level = []
        for x in range(count):
            run = x // ARITY * ARITY * HEX
            level.append((text[run:x * HEX], text[x * HEX + HEX:run + ARITY * HEX]))
        out.append(level)
    return out


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf's digest and its siblings, level by level, lead to."""
    for left, right in path:
        digest = hashlib.sha256((left + digest + right).encode()).hexdigest()
    return digest


def row_digest(*cols: str | Column) -> Column:
    """SHA-256, as binary, of the columns' values one after the other: ``-`` for a
    null, else the length in UTF-8 bytes, a colon and the value as text."""
    parts = []
    for c in cols:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Manifest(NamedTuple):
    """``layers[0]`` holds the rows' blocks, each further one the blocks over
    the block roots below; ``top`` does the same for the tree over all roots."""

    layers: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    block_levels: int = BLOCK_LEVELS


_BLOCK = ("tree long, block long, total long, n int, height int, root binary, nodes binary, "
          "ids array<{id_type}>, claimed array<binary>")


def _build(id_type: pa.DataType, block_levels: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        leaves = table.column("digest").to_pylist()
        total = table.column("total")[0].as_py()
        h = height(total, block_levels)
        nodes = build_block(leaves, h)
        return pa.table({
            "tree": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()),
            "total": pa.array([total], pa.int64()), "n": pa.array([len(leaves)], pa.int32()),
            "height": pa.array([h], pa.int32()), "root": pa.array([nodes[:32]], pa.binary()),
            "nodes": pa.array([nodes], pa.binary()),
            "ids": pa.array([table.column("id").to_pylist()], pa.list_(id_type)),
            "claimed": pa.array([table.column("claimed").to_pylist()], pa.list_(pa.binary()))})
    return run


def _layers(nodes: DataFrame, total: int, id_type: str, arrow_type: pa.DataType,
            block_levels: int) -> list[DataFrame]:
    """The blocks over ``nodes`` (tree, pos, total, digest, id, claimed) and, layer
    by layer, those over their roots. ``total`` is the largest tree's."""
    out, size = [], ARITY ** block_levels
    while True:
        keyed = nodes.withColumn("block", F.expr(f"pos div {size}"))
        blocks = keyed.groupBy("tree", "block").applyInArrow(
            _build(arrow_type, block_levels), _BLOCK.format(id_type=id_type))
        blocks = stage(blocks, "merkle")
        out.append(blocks)
        if total <= size:
            return out
        total = -(-total // size)
        nodes = blocks.filter(F.col("total") > size).select(
            "tree", F.col("block").alias("pos"), F.expr(f"(total + {size - 1}) div {size}").alias("total"),
            F.col("root").alias("digest"), F.lit(None).cast(id_type).alias("id"),
            F.lit(None).cast("binary").alias("claimed"))


def build_manifest(docs: DataFrame, leaf: Column, claimed: Column | None = None,
                   id_col: str = "doc_id", tree_col: str = "source", block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``docs``: a tree for each value of ``tree_col`` (null is
    one, too), its leaves by ``id_col`` (null first, ties by digest), and the
    tree over the roots in order of ``tree_col`` (null first, then by bytes). A block has ``block_levels`` levels of hashing.

    ``leaf`` is a row's digest (see :func:`row_digest`). ``claimed`` is the
    digest of what is later found in the row's place, null if that is the same;
    it isn't hashed into the trees, only kept for :func:`verify`. Rows are
    hashed once, ranked by range partitioning and dealt by block, so a tree that
    holds a third of all rows is spread like all others. An empty table has a
    manifest without layers and no root.
    """
    rows = stage(docs.select(
        F.col(f"`{tree_col}`").alias("name"), F.col(f"`{id_col}`").alias("id"), leaf.alias("digest"),
        (claimed if claimed is not None else F.lit(None).cast("binary")).alias("claimed")), "leaves")
    ranked, n = global_rank(rows, ["name", "id", "digest", "claimed"])
    if not n:
        return Manifest([], [], None, block_levels)
    trees, n_trees = global_rank(
        ranked.groupBy("name").agg(F.count("*").alias("total"), F.min("rank").alias("first")), ["first"],
        rank_col="tree")
    trees = trees.withColumn("tree", F.col("tree") - 1)
    largest = trees.agg(F.max("total")).first()[0]
    names = trees.select(F.col("name").alias("tree_name"), "tree", "total", "first")
    if n_trees <= BROADCAST_TREES:
        names = F.broadcast(names)
    nodes = (ranked.join(names, F.col("name").eqNullSafe(F.col("tree_name")))
             .select("tree", (F.col("rank") - F.col("first")).alias("pos"), "total", "digest", "id", "claimed"))
    field = rows.schema["id"].dataType
    id_type = field.simpleString()
    arrow_type = to_arrow_type(field)
    layers = _layers(nodes, largest, id_type, arrow_type, block_levels)
    roots = [b.filter(F.col("total") <= ARITY ** block_levels) for b in layers]
    subroots = roots[0]
    for other in roots[1:]:
        subroots = subroots.union(other)
    top = _layers(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("total"),
        F.col("root").alias("digest"), F.lit(None).cast(id_type).alias("id"),
        F.lit(None).cast("binary").alias("claimed")), n_trees, id_type, arrow_type, block_levels)
    return Manifest(layers, top, bytes(top[-1].select("root").first()[0]).hex(), block_levels)


_PATH = "lefts array<string>, rights array<string>, subroot binary"


def _paths(size: int):
    """The path of each leaf of a block, its own levels first."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                up = list(zip(r["lefts"], r["rights"]))
                levels = siblings(r["nodes"], r["n"], r["height"])
                lefts, rights = [], []
                for x in range(r["n"]):
                    path = [level[x // ARITY ** k] for k, level in enumerate(levels)] + up
                    lefts.append([p[0] for p in path])
                    rights.append([p[1] for p in path])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * r["n"], pa.int64()),
                     pa.array(range(r["block"] * size, r["block"] * size + r["n"]), pa.int64()),
                     pa.array(lefts, pa.list_(pa.string())), pa.array(rights, pa.list_(pa.string())),
                     pa.array([r["subroot"]] * r["n"], pa.binary())],
                    ["up_tree", "up_pos", "lefts", "rights", "subroot"])
    return run


def _verify(root: str, proofs: bool, id_type: pa.DataType):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                up = list(zip(r["lefts"], r["rights"]))
                n, h = r["n"], r["height"]
                levels = siblings(r["nodes"], n, h)
                nodes = np.frombuffer(r["nodes"], np.uint8).reshape(-1, 32)
                leaves = nodes[level_addresses(h + 1, h)[:n]].tobytes().hex()
                shared = "".join(a + b for a, b in up)
                rows = []
                for x in range(n):
                    leaf = leaves[x * HEX:x * HEX + HEX]
                    own = [level[x // ARITY ** k] for k, level in enumerate(levels)]
                    claimed = r["claimed"][x]
                    folded = fold(leaf if claimed is None else claimed.hex(), own + up)
                    proof = "".join([a + b for a, b in own]) + shared
                    rows.append((leaf, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root, own))
                cols = [pa.array(r["ids"], id_type), pa.array([x[0] for x in rows], pa.string()),
                        pa.array([r["subroot"].hex()] * n, pa.string()), pa.array([root] * n, pa.string()),
                        pa.array([x[1] for x in rows], pa.string()), pa.array([x[2] for x in rows], pa.string()),
                        pa.array([x[3] for x in rows], pa.bool_())]
                names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                if proofs:
                    cols += [pa.array([[p[k] for p in x[4] + up] for x in rows], pa.list_(pa.string())) for k in (0, 1)]
                    names += ["lefts", "rights"]
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def _with_paths(layers: list[DataFrame], over: DataFrame | None, size: int) -> DataFrame:
    """The blocks of the lowest layer with the path from their root up.

    ``over`` has the paths of the trees' roots by number (None: the roots have
    nothing above them)."""
    lifted = None
    for blocks in reversed(layers):
        done = blocks.filter(F.col("total") <= size)
        if over is None:
            none = F.array().cast("array<string>")
            done = done.withColumns({"lefts": none, "rights": none, "subroot": F.col("root")})
        else:
            paths = over.drop("up_tree", "subroot")
            done = (done.join(paths, F.col("tree") == F.col("up_pos")).drop("up_pos")
                    .withColumn("subroot", F.col("root")))
        if lifted is not None:
            more = blocks.filter(F.col("total") > size).join(
                lifted, (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_pos")))
            done = done.unionByName(more.select(*done.columns))
        lowest = done
        if blocks is not layers[0]:
            lifted = _expand(done, size)
    return lowest


def _expand(blocks: DataFrame, size: int) -> DataFrame:
    out = blocks.select("tree", "block", "n", "height", "nodes", "lefts", "rights", "subroot").mapInArrow(
        _paths(size), f"up_tree long, up_pos long, {_PATH}")
    return stage(out, "merkle-paths")


def verify(docs: DataFrame, manifest: Manifest, id_col: str = "doc_id", proofs: bool = False) -> DataFrame:
    """One row per row of ``docs``, of which ``manifest`` was built: ``id``, ``leaf``,
    ``subroot`` (of its tree), ``root``, ``proof_sha256`` (digest of its siblings
    as hex text, level by level up to the root, left to right), ``folded_root``
    (what the claimed digest, or else the leaf, leads to) and ``verified``
    (whether that is the root). ``proofs`` adds the siblings themselves, level by
    level: ``lefts`` and ``rights``.

    Digests are lowercase hex. A tree of one leaf has that as its root, and a
    table of one leaf has an empty proof. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    field = docs.schema[id_col].dataType
    schema = (f"id {field.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean" + (", lefts array<string>, rights array<string>" if proofs else ""))
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    size = ARITY ** manifest.block_levels
    over = _expand(_with_paths(manifest.top, None, size), size)
    blocks = _with_paths(manifest.layers, over, size)
    return blocks.select("n", "height", "nodes", "ids", "claimed", "lefts", "rights", "subroot").mapInArrow(
        _verify(manifest.root, proofs, to_arrow_type(field)), schema)
