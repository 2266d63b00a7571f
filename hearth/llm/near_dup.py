"""N-gram Jaccard join by MinHash banding (operator 10).

Every document becomes the set of its word n-grams. Documents with equal sets
form a class of copies, one of which (smallest id) stands for it. Band and row
counts follow from the recall wanted at the threshold; representatives meet in
Spark by their band hashes. Similarity is always verified on the full n-gram
sets. Work that grows with the square of a group is avoided in two steps:

* every bucket first compares its members with the smallest one, which settles
  nearly all groups of near copies; connected components follow;
* only pairs whose members are still in different components remain. Buckets
  holding such are cut into blocks by hash, and pairs of blocks compared inside
  a task; only links found leave it. No pair that shares a band is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import stage, text_or_empty

BLOCK = 256         # members of a block at most, about


def bands_for(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence the fewest false meetings,
    whose chance to meet at ``threshold`` is at least ``recall``."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= max_hashes and 1 - (1 - threshold ** rows) ** bands >= recall:
            return bands, rows
    raise ValueError("recall needs more hashes than max_hashes")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct 64-bit hashes of a text's word n-grams.

    Words are the lower-cased runs between white space. A text of fewer than n
    words has one n-gram of all its words; a text without words has none.
    """

    def __init__(self, n: int):
        self.n, self.seen = n, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        seen = self.seen
        if len(seen) > 500_000:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):      # order matters: each step mixes what came before
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
        return np.unique(out)


def _signatures(n: int, bands: int, rows: int, seed: int = 7):
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def run(batches):
        shingle = Shingler(n)
        for batch in batches:
            count, h1, h2, keys = [], [], [], []
            for text in batch.column("t").to_pylist():
                s = shingle(text)
                count.append(len(s))
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                h1.append((d >> 64) - (1 << 63))
                h2.append((d & ((1 << 64) - 1)) - (1 << 63))
                if not len(s):
                    keys.append(None)
                    continue
                low = np.full(bands * rows, np.iinfo(np.uint64).max)
                for at in range(0, len(s), 4096):       # multiply-shift, the high bits count
                    part = s[at:at + 4096]
                    for k in range(0, bands * rows, 16):
                        low[k:k + 16] = np.minimum(low[k:k + 16], (part * a[k:k + 16, None] + b[k:k + 16, None]).min(axis=1))
                band = low.reshape(bands, rows)
                out = np.arange(bands, dtype=np.uint64)
                for r in range(rows):
                    out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + band[:, r])
                keys.append(out.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tag"), pa.array(count, pa.int32()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "tag", "n", "h1", "h2", "bands"])
    return run


def similar(x: int, y: int, both: int, threshold: float) -> bool:
    return both >= threshold * (x + y - both) - 1e-9


def _verify(n: int, threshold: float):
    """Keep the pairs (a, b) whose n-gram sets reach the threshold."""
    def run(batches):
        shingle = Shingler(n)
        last = (None, None)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                if last[0] != ta:
                    last = (ta, shingle(ta))
                x, y = last[1], shingle(tb)
                keep.append(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _compare_groups(n: int, threshold: float, counts: bool, keys: int):
    """Compare the members of each pair of blocks; the rows come sorted by the
    first ``keys`` columns, so that a group's rows follow each other.

    ``counts``: the number of links of each member, weighted by the copies it
    stands for; else links that join different components, a forest of them.
    """
    def run(batches):
        shingle, sets, held = Shingler(n), {}, 0
        last, group = None, []

        def grams(i, text):
            nonlocal held
            if i not in sets:
                if held > 4_000_000:
                    sets.clear()
                    held = 0
                sets[i] = shingle(text)
                held += len(sets[i])
            return sets[i]

        def compare():
            i, j = last[-2:]
            side, ids, comp, copies, texts = (list(x) for x in zip(*group))
            own = [grams(k, t) for k, t in zip(ids, texts)]
            left = np.flatnonzero(np.array(side) == i)
            right = left if i == j else np.flatnonzero(np.array(side) == j)
            hit = _similar_matrix(own, left, right, threshold)
            if i == j:
                np.fill_diagonal(hit, False)
            if counts:
                w = np.array(copies, np.int64)
                out = list(zip([ids[k] for k in left], (hit @ w[right]).tolist()))
                return out if i == j else out + list(zip([ids[k] for k in right], (hit.T @ w[left]).tolist()))
            return _forest(ids, comp, [(left[x], right[y]) for x, y in np.argwhere(hit).tolist()])

        def rows(found):
            names = ["id", "n"] if counts else ["a", "b"]
            cols = list(zip(*found)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)
        for batch in batches:
            found = []
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols):
                if row[:keys] != last:
                    if group:
                        found += compare()
                    last, group = row[:keys], []
                group.append(row[keys:])
            yield rows(found)
        if group:
            yield rows(compare())
    return run


def _forest(ids: list, comp: list, links: list) -> list:
    root = {c: c for c in comp}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c
    edges = []
    for x, y in links:
        a, b = find(comp[x]), find(comp[y])
        if a != b:
            root[max(a, b)] = min(a, b)
            edges.append((ids[x], ids[y]))
    return edges


def _similar_matrix(sets: list[np.ndarray], left, right, threshold: float) -> np.ndarray:
    size = np.array([len(s) for s in sets])
    if len(left) * len(right) <= 16:
        both = np.array([[len(np.intersect1d(sets[x], sets[y], assume_unique=True)) if x != y else 0
                          for y in right] for x in left]).reshape(len(left), len(right))
    else:
        both = _overlaps(sets, left, right)
    union = size[left][:, None] + size[right][None, :] - both
    return both >= threshold * union - 1e-9


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, by products of membership rows over the
    n-grams that occur on both sides, a slice of n-grams at a time."""
    def flat(rows):
        if not len(rows):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return (np.concatenate([sets[k] for k in rows]),
                np.repeat(np.arange(len(rows)), [len(sets[k]) for k in rows]))
    gl, rl = flat(left)
    gr, rr = flat(right)
    grams = np.intersect1d(gl, gr)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(grams), 8192):
        part = grams[at:at + 8192]

        def rows(g, r, n):
            k = np.minimum(np.searchsorted(part, g), len(part) - 1)
            ok = part[k] == g
            m = np.zeros((n, len(part)), np.float32)
            m[r[ok], k[ok]] = 1
            return m
        out += rows(gl, rl, len(left)) @ rows(gr, rr, len(right)).T
    return np.rint(out).astype(np.int64)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, comp): the smallest id reachable over undirected edges (a, b).

    Each round links every node to the smallest of its neighbourhood and then
    follows the labels' labels; the table is written each round, so a lost
    executor costs one round. Ends when no label changes.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), name)
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b")
                .groupBy("a").agg(F.min("cb").alias("low")).withColumnRenamed("a", "id"))
        hooked = labels.join(near, "id").select("id", "comp", F.least("comp", "low").alias("new"))
        # the old component's label takes the smallest offer any of its members got
        offers = hooked.groupBy("comp").agg(F.min("new").alias("best")).withColumnRenamed("comp", "c")
        jump = offers.select(F.col("c").alias("best"), F.col("best").alias("further"))
        offers = offers.join(jump, "best", "left").select("c", F.coalesce("further", "best").alias("best"))
        step = stage(labels.join(offers, labels["comp"] == offers["c"])
                     .select("id", F.col("comp").alias("old"), F.least("comp", "best").alias("comp")), name)
        labels = step.select("id", "comp")
        if not step.filter("old <> comp").limit(1).count():
            return labels


def _in_blocks(members: DataFrame, key: list[str], salt: str) -> DataFrame:
    """Deal each group's members into blocks by hash, and repeat every member
    for each pair of blocks (i, j) it takes part in."""
    sizes = members.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = (members.join(sizes, key).withColumn("blocks", blocks)
           .withColumn("side", F.pmod(F.xxhash64("id", F.lit(salt)), F.col("blocks")).cast("int")))
    pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})


def _linked(pairs: DataFrame, key: list[str], texts: DataFrame, n: int, threshold: float, counts: bool, schema: str):
    key = [*key, "i", "j"]
    return (pairs.join(texts, "id").select(*key, "side", "id", "comp", "copies", "t")
            .repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(_compare_groups(n, threshold, counts, len(key)), schema))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    threshold: float = 0.8, recall: float = 0.9995, count_links: bool = True) -> DataFrame:
    """One row per id: ``id``, ``class_id`` (smallest id of the group of
    documents connected by links), ``copy_of`` (smallest id with an equal
    n-gram set), ``n_links`` (other documents whose similarity is at least
    ``threshold``, copies included; null unless ``count_links``).

    Ids are integers. Null texts count as empty; texts without words have no
    links and stand alone. Rows that repeat an id count as one document (one
    of their texts, the same in every run, speaks for it, in signatures as in
    comparisons). Rows without id
    take no part and aren't in the result. Extra columns are left aside. An
    empty table gives an empty result.
    """
    bands, rows = bands_for(threshold, recall)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))
    known = src.filter("id IS NOT NULL").withColumn("tag", F.xxhash64("t"))
    sig = stage(known.mapInArrow(_signatures(n, bands, rows), "id long, tag long, n int, h1 long, h2 long, bands array<long>"),
                "near-dup-sig")
    # an id that is repeated with other texts: the one with this signature and hash speaks for it
    one = sig.groupBy("id").agg(F.min(F.struct("h1", "h2", "n", "tag", "bands")).alias("s")).select("id", "s.*")
    # copies: equal sets; a text without words stands alone
    copies = one.filter("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                                         F.min_by("bands", "id").alias("bands"))
    reps = stage(copies.select("h1", "h2", "rep", "copies", "bands"), "near-dup-reps")
    hits = reps.select(F.col("rep").alias("id"), F.posexplode("bands").alias("band", "key"))
    buckets = hits.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("id").alias("first")).filter("size > 1")
    met = stage(hits.join(buckets.select("band", "key", "first"), ["band", "key"]), "near-dup-met")

    involved = met.select("id").distinct()
    speakers = one.select("id", "tag").join(involved, "id", "left_semi")
    texts = stage(known.join(speakers, ["id", "tag"], "left_semi").groupBy("id").agg(F.min("t").alias("t")), "near-dup-texts")
    stars = met.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    pairs = (stars.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
             .join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb"))
    edges = stage(pairs.mapInArrow(_verify(n, threshold), "a long, b long"), "near-dup-edges")
    labels = components(edges, "near-dup-comp")

    # pairs that share a bucket and aren't connected yet
    comp = involved.join(labels, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))
    spread = met.join(comp, "id")
    # of buckets with the same members, as two hash sums over these say, one is enough
    mixed = (spread.groupBy("band", "key").agg(
                 F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"),
                 F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s1"),
                 F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(20,0)")).alias("s2"))
             .filter("lo <> hi").groupBy("size", "s1", "s2").agg(F.min(F.struct("band", "key")).alias("one"))
             .select("one.band", "one.key"))
    rest = spread.join(mixed, ["band", "key"]).select("band", "key", "id", "comp", F.lit(1).cast("long").alias("copies"))
    more = _linked(_in_blocks(rest, ["band", "key"], "bucket"), ["band", "key"], texts, n, threshold, False, "a long, b long")
    labels = components(edges.union(more), "near-dup-comp2")

    out = reps.select("h1", "h2", "rep", "copies")
    full = out.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("class_id", F.coalesce("comp", "rep"))
    if count_links:
        linked = labels.join(reps.select(F.col("rep").alias("id"), "copies"), "id").select(F.col("comp").alias("grp"), "id", "comp", "copies")
        counted = (_linked(_in_blocks(linked, ["grp"], "class"), ["grp"], texts, n, threshold, True, "id long, n long")
                   .groupBy("id").agg(F.sum("n").alias("linked")))
        full = full.join(counted.withColumnRenamed("id", "rep"), "rep", "left")
    links = F.coalesce("linked", F.lit(0)) + F.col("copies") - 1 if count_links else F.lit(None).cast("long")
    full = full.select("h1", "h2", "rep", "class_id", links.alias("n_links"))
    rows_out = one.join(full, ["h1", "h2"], "left")
    wordless = F.col("n") == 0
    result = rows_out.select("id", F.when(wordless, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                             F.when(wordless, F.col("id")).otherwise(F.col("rep")).alias("copy_of"),
                             F.when(wordless, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return result


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows that stay, with the input's columns: those of each
    group's smallest id, and rows without id.

    Rows that repeat an id with the same text stay or go together. Where an id
    is repeated with different texts, each text is a document of its own: it
    goes if an id that isn't repeated so is in its group, or of several such
    texts another one, by hash.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("row_id"),
                       F.xxhash64(text_or_empty(f"`{text_col}`")).alias("tag"))
    repeated = stage(rows.filter("row_id IS NOT NULL").groupBy("row_id")
                     .agg(F.min("tag").alias("low"), F.max("tag").alias("high"))
                     .filter("low <> high").select(F.col("row_id").alias("twice")), "near-dup-repeated")
    if repeated.isEmpty():
        own = rows.withColumn("own_id", F.col("row_id"))
    else:
        # ids of 61 bits behind all others stand for an id's different texts
        behind = F.shiftrightunsigned(F.xxhash64("row_id", "tag"), 3) + F.lit(3 << 61)
        own = (rows.join(repeated, F.col("row_id") == F.col("twice"), "left")
               .withColumn("own_id", F.when(F.col("twice").isNull(), F.col("row_id")).otherwise(behind)))
    texts = own.select("own_id", F.col(f"row.`{text_col}`").alias("text"))
    classes = near_duplicates(texts, "own_id", "text", count_links=False, **options)
    gone = classes.filter("id <> class_id").select(F.col("id").alias("gone_id"))
    return own.join(gone, F.col("own_id") == F.col("gone_id"), "left_anti").select("row.*")
