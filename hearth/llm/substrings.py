"""Repeated byte strings by Burrows-Wheeler interval expansion (operator 4).

A string of ``min_len`` bytes that also starts earlier (smaller document id,
or the same document further left) is a repeat; bytes covered by repeats go.

1. *Anchors.* Of every ``min_len`` bytes of a document one ``gram``-byte string
   is the window's minimum by hash (winnowing), and equal strings have the same
   one. Around an anchor lies its context: all strings of ``min_len`` bytes that
   have it as their minimum. Anchors meet in Spark by their hash, once, after
   equal contexts of a task have been brought together.
2. *Contexts.* Where all contexts of an anchor are equal, all but the first are
   repeats from end to end; one that occurs once can't lie in a repeat. Where
   they differ, the first of each kind is compared further.
3. *Interval expansion.* Contexts meet by their anchor's hash. A task sorts
   the suffixes of a bounded batch of contexts, and extends intervals of their
   Burrows-Wheeler transform backwards, breadth first (``bwt``): boundaries
   between neighbouring suffixes come by increasing length of their common
   prefix, until ``min_len``. All but the earliest of what isn't separated by
   then are repeats.
4. *Removal.* The repeats' spans return to the documents.

An anchor with more different contexts than a batch may hold is split: strings
are dealt by where in them the anchor lies, first half or second, and by the
hash of the bytes that all strings of that half share; again, until groups are
small or hold one string only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import bwt
from hearth.llm.common import release, stage, text_or_empty

PIECE = 1 << 18
BATCH_BYTES = 1_500_000
HOT = 8_000             # contexts of one anchor that a batch surely holds
LAST_ID = (1 << 63) - 1

BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Winnow:
    """Window minima of polynomial hashes of all ``gram``-byte strings."""

    def __init__(self, min_len: int, gram: int):
        self.min_len, self.gram, self.window = min_len, gram, min_len - gram + 1
        one = np.ones(1, np.uint64)
        self.power = np.cumprod(np.concatenate([one, np.full(PIECE, BASE, np.uint64)]), dtype=np.uint64)
        self.inverse = np.cumprod(np.concatenate([one, np.full(PIECE, pow(BASE, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        self.byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

    def piece(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(b), self.gram
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[b] * self.power[:n], out=total[1:])
        h = _mix((total[k:] - total[:-k]) * self.inverse[:n - k + 1])
        # the leftmost of the smallest: the place in the low bits
        low = (h & ~np.uint64(PIECE * 2 - 1)) | np.arange(len(h), dtype=np.uint64)
        m, s = low, 1
        while 2 * s <= self.window:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if s < self.window:
            m = np.minimum(m[:len(m) - (self.window - s)], m[self.window - s:])
        at = (m[np.concatenate([[True], m[1:] != m[:-1]])] & np.uint64(PIECE * 2 - 1)).astype(np.int64)
        return at, h[at]

    def __call__(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the document's anchors."""
        if len(b) < self.min_len:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(b) <= PIECE:
            return self.piece(b)
        step = PIECE - self.min_len + 1
        parts = [(at, self.piece(b[at:at + PIECE])) for at in range(0, len(b) - self.min_len + 1, step)]
        where = np.concatenate([p[0] + at for at, p in parts])
        where, first = np.unique(where, return_index=True)
        return where, np.concatenate([p[1] for _, p in parts])[first]


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


LEN_BITS = 12           # a place: the anchor, and in the low bits the bytes from it to the end
SORT_ROWS = 2_000_000


def _unpack(w: np.ndarray, side: int):
    """Anchor, start and end of a place's context."""
    at = w >> LEN_BITS
    return at, np.maximum(at - side, 0), at + (w & ((1 << LEN_BITS) - 1))


def _anchors(min_len: int, gram: int):
    """(h, c, id, tag, w): anchor, context, document (its id and its text's hash) and place. Of contexts that are
    equal within a task the first is sent on; the others are known to be repeats
    and leave with a null context, under a key that spreads them."""
    def run(batches):
        winnow, side = Winnow(min_len, gram), min_len - gram
        held, size = [], 0

        def send():
            h, c, i, tag, w = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((w, tag, i, c, h))
            h, c, i, tag, w = h[order], c[order], i[order], tag[order], w[order]
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])])
            h = np.where(again, _mix((i ^ tag).view(np.uint64)).view(np.int64), h)
            for k in range(0, len(h), 100_000):
                cut = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[cut]), pa.array(c[cut], mask=again[cut]), pa.array(i[cut]), pa.array(tag[cut]), pa.array(w[cut])],
                    ["h", "c", "id", "tag", "w"])
        for batch in batches:
            for i, tag, text in zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(),
                                    batch.column("t").cast(pa.binary()).to_pylist()):
                at, h = winnow(np.frombuffer(text, np.uint8))
                if not len(at):
                    continue
                lo, hi = np.maximum(at - side, 0), np.minimum(at + min_len, len(text))
                c = np.array([_hash(text[a:b] + bytes((p - a,))) for a, b, p in zip(lo.tolist(), hi.tolist(), at.tolist())], np.int64)
                w = (at << LEN_BITS) | (hi - at)
                held.append((h.view(np.int64), c, np.full(len(at), i, np.int64), np.full(len(at), tag, np.int64), w))
                size += len(at)
            if size >= SORT_ROWS:
                yield from send()
                held, size = [], 0
        if held:
            yield from send()
    return run


def _classify(min_len: int, gram: int):
    """Rows come sorted by h, c, id, tag and w. A repeat leaves as (null, id, tag, w),
    the first of each of several different contexts of an anchor as (h, id, tag, w)."""
    def run(batches):
        last_h = last_c = None          # of the row before
        first, several = None, False    # the anchor's first row, while it is the only kind
        for batch in batches:
            if not batch.num_rows:
                continue
            h, i, tag, w = (batch.column(k).to_numpy() for k in ("h", "id", "tag", "w"))
            null = batch.column("c").is_null().to_numpy(zero_copy_only=False)
            c = batch.column("c").fill_null(0).to_numpy()
            same_h = np.concatenate([[last_h is not None and h[0] == last_h], h[1:] == h[:-1]])
            same_c = same_h & np.concatenate([[last_c is not None and c[0] == last_c], c[1:] == c[:-1]]) \
                & ~null & ~np.concatenate([[False], null[:-1]])
            repeat = null | same_c
            kind = ~repeat              # the first of its kind
            # anchors' runs in this batch; the first may go on from the batch before
            run_no = np.cumsum(~same_h) - (0 if same_h[0] else 1)
            kinds = np.bincount(run_no, kind)
            carried = bool(same_h[0])
            many = kinds > 1
            if carried:
                many[0] = several or kinds[0] + (first is not None) > 1
            out_h, out_i, out_tag, out_w = [], [], [], []
            if carried and many[0] and not several and first is not None:
                out_h.append(last_h)
                out_i.append(first[0])
                out_tag.append(first[1])
                out_w.append(first[2])
            go = kind & many[run_no]
            last_run = run_no == run_no[-1]
            if not many[run_no[-1]]:    # the last anchor's only kind waits for the next batch
                k = np.flatnonzero(kind & last_run)
                if len(k):
                    first = (int(i[k[0]]), int(tag[k[0]]), int(w[k[0]]))
                elif not (carried and run_no[-1] == 0):
                    first = None
            else:
                first = None
            several = bool(many[run_no[-1]])
            last_h, last_c = int(h[-1]), None if null[-1] else int(c[-1])
            _, lo, hi = _unpack(w, min_len - gram)
            full = repeat & (hi - lo >= min_len)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(out_h, pa.int64()), pa.nulls(int(full.sum()), pa.int64()), pa.array(h[go], pa.int64())]),
                 pa.concat_arrays([pa.array(out_i, pa.int64()), pa.array(i[full], pa.int64()), pa.array(i[go], pa.int64())]),
                 pa.concat_arrays([pa.array(out_tag, pa.int64()), pa.array(tag[full], pa.int64()), pa.array(tag[go], pa.int64())]),
                 pa.concat_arrays([pa.array(out_w, pa.int64()), pa.array(w[full], pa.int64()), pa.array(w[go], pa.int64())])],
                ["h", "id", "tag", "w"])
    return run


def _cut(min_len: int, gram: int):
    """The bytes of each listed context of a document; ``p`` to ``q`` are the
    places of the anchor in the strings that count."""
    def run(batches):
        for batch in batches:
            rows = []
            for i, tag, text, reps in zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(),
                                          batch.column("t").cast(pa.binary()).to_pylist(), batch.column("reps").to_pylist()):
                at, lo, hi = _unpack(np.array([r["w"] for r in reps], np.int64), min_len - gram)
                rows += [(r["h"], i, tag, a, b, 0, min_len - gram, text[b:e])
                         for r, a, b, e in zip(reps, at.tolist(), lo.tolist(), hi.tolist())]
            yield _context_rows(rows)
    return run


CONTEXT = "h long, id long, tag long, at int, lo int, p int, q int, data binary"
SPAN = "id long, tag long, s int, e int"


def _context_rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.binary()]
    cols = list(zip(*rows)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["h", "id", "tag", "at", "lo", "p", "q", "data"])


def _halve(min_len: int):
    """Deal the strings of a context by the half of places p..q their anchor is in."""
    def run(batches):
        for batch in batches:
            rows = []
            for _, i, tag, at, lo, p, q, data in zip(*[c.to_pylist() for c in batch.columns]):
                mid = (p + q) // 2
                for a, b in ((p, mid), (mid + 1, q)):
                    # strings start at at - b .. at - a; these bytes are in all of them
                    s, e = at - a, at - b + min_len
                    if s < lo or e > lo + len(data):
                        continue        # none of the strings is whole
                    new_lo, new_hi = max(lo, at - b), min(lo + len(data), at - a + min_len)
                    key = _hash(data[s - lo:e - lo] + bytes((a, b)))
                    rows.append((key, i, tag, at, new_lo, a, b, data[new_lo - lo:new_hi - lo]))
            yield _context_rows(rows)
    return run


def repeats(batch: list[tuple], min_len: int) -> list[tuple]:
    """Spans (id, tag, start, end) of repeats among contexts (id, tag, lo, data)."""
    text = np.frombuffer(b"\xff".join([x[3] for x in batch]) + b"\xff", np.uint8)
    sa, run = bwt.long_prefix_runs(text, min_len)
    size = np.array([len(x[3]) for x in batch])
    first = np.cumsum(size + 1) - (size + 1)
    owner = np.repeat(np.arange(len(batch)), size + 1)
    inside = np.arange(len(text)) - first[owner]
    whole = inside + min_len <= size[owner]
    docs = {d: k for k, d in enumerate(sorted({(x[0], x[1]) for x in batch}))}
    doc = np.array([docs[x[0], x[1]] for x in batch], np.int64)
    place = np.array([x[2] for x in batch], np.int64)[owner] + inside
    order = (doc[owner] << 32) | place          # earlier is smaller
    keep = whole[sa]
    sa, run = sa[keep], run[keep]
    if not len(sa):
        return []
    heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    least = np.repeat(np.minimum.reduceat(order[sa], heads), np.diff(np.concatenate([heads, [len(sa)]])))
    hit = np.sort(sa[order[sa] > least])
    if not len(hit):
        return []
    new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])
    begin, end = hit[new], hit[np.concatenate([new[1:], [True]])]
    return [(batch[k][0], batch[k][1], s, e) for k, s, e in
            zip(owner[begin].tolist(), place[begin].tolist(), (place[end] + min_len).tolist())]


def _span_rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)], ["id", "tag", "s", "e"])


def _expand(min_len: int):
    """Rows come sorted by anchor; whole groups gather to batches."""
    def run(batches):
        batch, group, size, grown, last = [], [], 0, 0, None
        for rows in batches:
            out = []
            for h, i, tag, lo, data in zip(*[rows.column(c).to_pylist() for c in ("h", "id", "tag", "lo", "data")]):
                if h != last:
                    if size + grown > BATCH_BYTES and batch:
                        out += repeats(batch, min_len)
                        batch, size = [], 0
                    batch, size, group, grown, last = batch + group, size + grown, [], 0, h
                group.append((i, tag, lo, data))
                grown += len(data) + 1
            yield _span_rows(out)
        if size + grown > BATCH_BYTES and batch:
            yield _span_rows(repeats(batch, min_len))
            batch = []
        if batch or group:
            yield _span_rows(repeats(batch + group, min_len))
    return run


def _remove(batches):
    for batch in batches:
        kept, n_bytes, removed, starts, ends = [], [], [], [], []
        for text, spans in zip(batch.column("t").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
            n_bytes.append(len(text))
            if not spans:
                kept.append(text)
                removed.append(0)
                starts.append([])
                ends.append([])
                continue
            change = np.zeros(len(text) + 1, np.int64)
            np.add.at(change, [x["s"] for x in spans], 1)
            np.add.at(change, [x["e"] for x in spans], -1)
            gone = np.cumsum(change) > 0            # one place past the end is never covered
            edge = np.diff(gone.astype(np.int8), prepend=0)
            starts.append(np.flatnonzero(edge == 1))
            ends.append(np.flatnonzero(edge == -1))
            removed.append(int(gone.sum()))
            kept.append(np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(kept, pa.binary())],
            ["row", "n_bytes", "n_removed", "span_start", "span_end", "kept"])


def find_repeats(own: DataFrame, min_len: int, gram: int, hot: int = HOT) -> DataFrame:
    """Spans (id, tag, s, e) of the repeats in ``own`` (id, tag, t; no two rows with equal id and tag)."""
    spark = own.sparkSession
    anchors = own.mapInArrow(_anchors(min_len, gram), "h long, c long, id long, tag long, w long")
    marked = stage(anchors.repartition("h").sortWithinPartitions("h", "c", "id", "tag", "w")
                   .mapInArrow(_classify(min_len, gram), "h long, id long, tag long, w long"), "substrings-marked")
    release(spark)
    # overlapping spans of a document meet and are merged before they are kept
    spans = stage(marked.filter("h IS NULL").groupBy("id", "tag").agg(F.collect_set("w").alias("ws"))
                  .mapInArrow(_merge_spans(min_len - gram), SPAN), "substrings-copies")
    release(spark)
    reps = marked.filter("h IS NOT NULL").groupBy("id", "tag").agg(F.collect_list(F.struct("h", "w")).alias("reps"))
    work = stage(own.join(reps, ["id", "tag"]).select("id", "tag", "t", "reps")
                 .mapInArrow(_cut(min_len, gram), CONTEXT), "substrings-contexts")
    release(spark)
    while True:
        sizes = work.groupBy("h").agg(F.count("*").alias("m"))
        large = sizes.filter(F.col("m") > hot)
        small = work.join(large, "h", "left_anti")
        found = small.repartition("h").sortWithinPartitions("h").mapInArrow(_expand(min_len), SPAN)
        spans = spans.union(stage(found, "substrings-found"))
        if large.limit(1).count() == 0:
            release(spark)
            return spans
        halves = stage(work.join(large.select("h"), "h").select(*work.columns).mapInArrow(_halve(min_len), CONTEXT), "substrings-halves")
        # strings with the anchor in one place only: a group is one string, its first stays
        single = halves.filter("p = q")
        firsts = single.groupBy("h").agg(F.min(F.struct("id", "tag", "at")).alias("one"))
        spans = spans.union(single.join(firsts, "h").filter(F.struct("id", "tag", "at") != F.col("one"))
                            .select("id", "tag", F.col("lo").alias("s"), (F.col("lo") + min_len).alias("e")))
        work = halves.filter("p < q")


def _merge_spans(side: int):
    def run(batches):
        for batch in batches:
            out = []
            for i, tag, ws in zip(*[c.to_pylist() for c in batch.columns]):
                _, lo, hi = _unpack(np.sort(np.array(ws, np.int64)), side)       # starts and ends both ascend
                new = np.concatenate([[True], lo[1:] > hi[:-1]])
                out += [(i, tag, a, b) for a, b in zip(lo[new].tolist(), hi[np.concatenate([new[1:], [True]])].tolist())]
            yield _span_rows(out)
    return run


def _distinct(own: DataFrame) -> DataFrame:
    """One row of each (id, tag). Only rows that are repeated are brought together."""
    twice = stage(own.groupBy("id", "tag").agg(F.count("*").alias("n")).filter("n > 1").select("id", "tag"), "substrings-twice")
    if not twice.limit(1).count():
        return own
    return own.join(twice, ["id", "tag"], "left_anti").unionByName(
        own.join(twice, ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 100,
                   gram: int = 40, hot: int = HOT) -> DataFrame:
    """One row per input row: ``row`` (the input row without its text),
    ``n_bytes``, ``n_removed``, ``span_start`` and ``span_end`` (the removed
    runs), ``kept`` (the remaining bytes).

    Ids are integers. Null texts count as empty; texts under ``min_len`` bytes
    keep all. Rows without id come after all others. Rows that repeat an id
    with another text come in the order of their texts' hashes (64 bits, which
    also tell the texts of an id apart); so do rows without id. Rows that repeat
    id and text are one document and get the same result, and so are rows
    without id of equal text. An empty table gives an empty result; extra
    columns travel inside ``row``.
    """
    text = text_or_empty(f"`{text_col}`")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
                        F.xxhash64(text).alias("tag"), text.alias("t"))
    spans = find_repeats(_distinct(keyed.select("id", "tag", "t")), min_len, gram, hot)
    by_doc = spans.groupBy("id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = keyed.join(by_doc, ["id", "tag"], "left").select("row", "t", "spans")
    return joined.mapInArrow(_remove, f"row {keyed.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, "
                             "span_start array<int>, span_end array<int>, kept binary")
