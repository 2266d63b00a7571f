"""Periodic runs of words (operator 11).

A run is a stretch of words with smallest period q that no neighbouring word
extends. Each run holds a Lyndon root: a place where the longest Lyndon word,
under one of the two orders of the words (forwards or backwards), has length q.
Phase one of Baier's suffix sorter groups the places by exactly these longest
Lyndon words, so it yields the Lyndon array of an order directly, and the roots
are extended to both sides by longest common extensions.

Everything happens inside a document: the job is one narrow pass over the
table, without a shuffle, and a task holds one chunk of documents at a time.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of text whose words are numbered together in a task
CHUNK_BYTES = 4_000_000
#: rounds of the search for stretches; each only makes the next step cheaper
CUT_ROUNDS = 4


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place (its Lyndon array).

    Phase one of Baier's sorter. Places begin in groups of equal rank, whose
    context is that one letter. Groups are taken from the highest to the
    lowest. Each place of the taken group is hung on its parent, the nearest
    place to the left that lies in a lower group. Parents that got k children
    leave their group for a new one right above it, whose context is the old
    one and k times the taken group's, more children higher. A place's context
    is final when its group is taken, and is its longest Lyndon word.
    """
    order = {r: g for g, r in enumerate(sorted(set(ranks)))}
    group = [order[r] for r in ranks]
    context = [1] * len(order)
    above = [*range(1, len(order)), -1]
    below = list(range(-1, len(order) - 1))
    members: list[list[int]] = [[] for _ in order]
    for place, g in enumerate(group):
        members[g].append(place)
    left = list(range(-1, len(ranks) - 1))
    taken = bytearray(len(ranks))
    lengths = [0] * len(ranks)
    g = len(order) - 1
    while g >= 0:
        here = [i for i in members[g] if group[i] == g]
        members[g] = []
        width = context[g]
        for i in here:
            taken[i] = 1
            lengths[i] = width
        children: dict[int, int] = {}
        for i in here:
            parent = left[i]
            while parent >= 0 and taken[parent]:
                parent = left[parent]
            while (step := left[i]) != parent:      # shorten the way for later places
                left[i], i = parent, step
            if parent >= 0:
                children[parent] = children.get(parent, 0) + 1
        for k in sorted(set(children.values()), reverse=True):
            moved: dict[int, int] = {}
            for parent, count in children.items():
                if count == k:
                    old = group[parent]
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(context)
                        context.append(context[old] + k * width)
                        members.append([])
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = new
                        if up >= 0:
                            below[up] = new
                    group[parent] = new
                    members[new].append(parent)
        g = below[g]
    return lengths


def common_extension(words: np.ndarray, i: int, j: int) -> int:
    """How many words from place ``i`` on equal those from ``j`` on (i < j)."""
    room, same, step = len(words) - j, 0, 16
    while same < room:
        step = min(step, room - same)
        equal = words[i + same:i + same + step] == words[j + same:j + same + step]
        if not equal.all():
            return same + int(equal.argmin())
        same += step
        step *= 4
    return room


def find_runs(words: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``min_length`` words and
    ``min_exponent`` periods, by start, then period.

    A run's first root starts in its first period, so at least
    ``min_exponent - 1`` periods and a word follow from there: roots without
    that room, or whose first and last word don't come again, extend to no
    run. Roots inside a run of their period, already extended, are its own.
    """
    n, backwards = len(words), words[::-1]
    found = set()
    place = np.arange(n)
    for ranks in (words.tolist(), (-words).tolist()):
        period = np.array(lyndon_lengths(ranks), dtype=np.int64)
        root = place[place + (min_exponent - 1) * period < n]
        root = root[words[root] == words[root + period[root]]]
        if min_exponent > 2:
            last = root + period[root] - 1
            root = root[words[last] == words[last + period[root]]]
        q_before, end = 0, 0
        for i in root[np.lexsort((root, period[root]))].tolist():
            q = int(period[i])
            if q == q_before and i + q <= end:
                continue
            j = i + q
            start = i - common_extension(backwards, n - j, n - i)
            q_before, end = q, j + common_extension(words, i, j)
            if end - start >= max(min_length, min_exponent * q):
                found.add((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, owner: np.ndarray, min_length: int, min_exponent: int):
    """Places and stretch numbers of the words that can lie in a run.

    A word of a run comes at least ``min_exponent`` times in it, so rarer
    words of a document end every run. What lies between them are stretches,
    in which the same holds again; those below ``min_length`` words hold none.
    """
    where, stretch = np.arange(len(words)), owner
    for _ in range(CUT_ROUNDS):
        if not len(where):
            break
        _, same, times = np.unique(stretch * (int(words.max()) + 1) + words[where],
                                   return_inverse=True, return_counts=True)
        often = times[same] >= min_exponent
        where, before = where[often], stretch[often]
        new = np.ones(len(where), bool)
        new[1:] = (np.diff(where) != 1) | (np.diff(before) != 0)
        number = np.cumsum(new) - 1
        keep = np.bincount(number)[number] >= min_length if len(number) else np.zeros(0, bool)
        where, stretch = where[keep], number[keep]
        if often.all() and keep.all():
            break
    return where, stretch


def chunk_runs(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a chunk, given as lists of words."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    words = pa.array(chain.from_iterable(texts), pa.binary(), size=int(sizes.sum()))
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    where, stretch = stretches(codes, owner, min_length, min_exponent)
    if len(where):
        cuts = np.flatnonzero(np.diff(stretch)) + 1
        for places in np.split(where, cuts):
            doc = int(owner[places[0]])
            offset = int(places[0] - first[doc])
            runs[doc] += [(offset + s, n, q) for s, n, q in find_runs(codes[places], min_length, min_exponent)]
    return runs


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep)])


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(min_length: int, min_exponent: int):
    def chunks(texts):
        at, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= CHUNK_BYTES:
                yield at, k + 1
                at, size = k + 1, 0
        if at < len(texts):
            yield at, len(texts)

    def run(batches):
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for a, b in chunks(texts):
                words = [t.split() for t in texts[a:b]]
                runs = chunk_runs(words, min_length, min_exponent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], _RUN),
                     pa.array([_kept(w, x) for w, x in zip(words, runs)], pa.string())],
                    ["row", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """One row per input row: ``row`` (the input row without its text),
    ``n_words``, ``runs`` (array of start, length and period in words, by
    start, then period) and ``collapsed``, the text with one period left of
    each run, its words joined by one space.

    Words are the parts between ASCII white space, compared by their bytes.
    A run has at least ``min_length`` words and ``min_exponent`` (2 or more)
    times its smallest period. A word goes if any run holds it after the run's
    first period. A null, empty or blank text has no words and no runs, and
    collapses to an empty text. Repeated rows stay apart; the id, if null or
    repeated, plays no part. An empty table gives an empty result.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    row = own.schema["row"].dataType.simpleString()
    return own.mapInArrow(_find(min_length, min_exponent),
                          f"row {row}, n_words long, "
                          "runs array<struct<start: long, length: long, period: long>>, collapsed string")
