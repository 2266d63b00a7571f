"""Operator 13 against a tree built one node at a time."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import ORACLES, QUERIES, merkle
from tests.conftest import SF0001
from tests.llm.conftest import AWKWARD


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[k:k + 3])) for k in range(0, len(last), 3)])
    return out


def path_of(levels, x):
    out = []
    for level in levels[:-1]:
        run = x // 3 * 3
        out.append((level[run:x], level[x + 1:run + 3]))
        x //= 3
    return out


def brute(rows):
    """(tree, id, digest, claimed) rows to sorted (id, leaf, subroot, root, proof, folded, verified)."""
    trees: dict = {}
    for tree, key, digest, claimed in rows:
        trees.setdefault(tree, []).append((key is not None, key or 0, digest, claimed))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    order = {t: sorted(trees[t], key=lambda r: r[:3]) for t in names}
    built = {t: levels_of([r[2] for r in order[t]]) for t in names}
    top = levels_of([built[t][-1][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for x, (has, key, digest, claimed) in enumerate(order[t]):
            path = path_of(built[t], x) + path_of(top, k)
            folded = claimed or digest
            for before, after in path:
                folded = sha("".join(before) + folded + "".join(after))
            proof = sha("".join(h for before, after in path for h in before + after))
            out.append((key if has else None, digest, built[t][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", range(1, 8))
def test_van_emde_boas_addresses(levels):
    places = [merkle.level_addresses(levels, d) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.tree_size(levels)))
    assert places[0].tolist() == [0]
    # an aligned lower subtree of the first split lies in one piece
    top = levels // 2
    if 0 < top < levels:
        for b in range(3 ** top):
            piece = np.concatenate([places[top + d][b * 3 ** d:(b + 1) * 3 ** d] for d in range(levels - top)])
            first = merkle.tree_size(top) + b * merkle.tree_size(levels - top)
            assert sorted(piece.tolist()) == list(range(first, first + merkle.tree_size(levels - top)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 80, 729])
def test_a_block_is_the_tree(n):
    leaves = [hashlib.sha256(b"%d" % k).digest() for k in range(n)]
    want = levels_of([x.hex() for x in leaves])
    h = merkle.height(n)
    block = merkle.build_block(leaves, h)
    assert len(want) == h + 1 and block[:32].hex() == want[-1][0]
    levels = merkle.siblings(block, n, h)
    for x in {0, n // 2, n - 1}:
        path = [level[x // 3 ** k] for k, level in enumerate(levels)]
        assert path == [("".join(a), "".join(b)) for a, b in path_of(want, x)]
        assert merkle.fold(leaves[x].hex(), path) == want[-1][0]


def test_several_layers_match_brute_force(spark):
    """Blocks of 9 leaves, so that 1 to 1,000 leaves take one to four layers."""
    rng = random.Random(2)
    sizes = {None: 10, "": 1, "hot": 1000, "é": 82, "z": 9, "Z": 28} | {f"s{k}": rng.randrange(1, 4) for k in range(30)}
    rows = []
    for name, size in sizes.items():
        for k in range(size):
            digest = sha(f"{name} {k // 3}")
            rows.append((name, rng.choice([None, k, k // 2]), digest, sha(digest) if k // 3 % 4 == 0 else None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, doc_id long, digest string, claimed string").repartition(5)
    manifest = merkle.build_manifest(df, F.unhex("digest"), F.unhex("claimed"), block_levels=2)
    assert len(manifest.layers) == 4 and len(manifest.top) == 2
    got = merkle.verify(df, manifest, proofs=True).collect()
    assert sorted([(r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got],
                  key=str) == brute(rows)
    for r in got:
        assert merkle.fold(r.leaf, list(zip(r.lefts, r.rights))) == r.root


def test_merkle_edges(spark, awkward, empty):
    fields = ["doc_id", "text"]
    docs = awkward.withColumn("source", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")))
    manifest = merkle.build_manifest(docs, merkle.row_digest(*fields))
    got = [tuple(r) for r in merkle.verify(docs, manifest).collect()]

    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    rows = [(str(k) if k % 3 else None, d, sha(enc(d) + enc(t)), None) for k, (d, t) in enumerate(AWKWARD)]
    assert sorted(got, key=str) == brute(rows)
    none = merkle.build_manifest(empty, merkle.row_digest(*fields))
    assert none.root is None and merkle.verify(empty, none).count() == 0
    one = docs.limit(1)
    manifest = merkle.build_manifest(one, merkle.row_digest(*fields))
    row = merkle.verify(one, manifest, proofs=True).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == manifest.root and row.verified
    assert row.proof_sha256 == sha("") and row.lefts == row.rights == []


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    res = con.execute(ORACLES["op13_merkle_manifest"])
    names = [c[0] for c in res.description]
    want = sorted(res.fetchall())
    got = QUERIES["op13_merkle_manifest"](spark, SF0001).select(*names).collect()
    assert sorted(tuple(r) for r in got) == want
    assert {r.verified for r in got} == {True, False}
