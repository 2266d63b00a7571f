"""Suffixes that share at least a given number of first bytes, by interval
expansion on a Burrows-Wheeler transform. Plain arrays, one batch at a time."""

from __future__ import annotations

import numpy as np

END = 255               # ends every string; no byte of UTF-8 has this value
FIRST = 5               # bytes that the first sorting round looks at
MAX_TEXT = (1 << 21) - 2    # positions are packed in 21 bits


def suffix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sa, rank, heads): suffixes in order of their first ``depth`` bytes at
    least, ties by position; each suffix's place; and where in ``sa`` the first
    ``FIRST`` bytes change.

    Prefix doubling; in each round the pair of ranks and the position are one
    64-bit number, so a round is a plain sort.
    """
    n = len(text)
    if n > MAX_TEXT:
        raise ValueError("text too long for one batch")
    low = np.uint64((1 << 21) - 1)
    place = np.arange(n, dtype=np.uint64)
    padded = np.concatenate([text, np.full(FIRST, END, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(FIRST):
        key = (key << np.uint64(8)) | padded[k:k + n]
    packed = np.sort((key << np.uint64(21)) | place)
    heads, length = None, FIRST
    while True:
        sa = (packed & low).astype(np.int64)
        group = packed >> np.uint64(21)
        new = np.concatenate([[True], group[1:] != group[:-1]])
        if heads is None:
            heads = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        rank = np.empty(n, np.uint64)
        rank[sa] = number
        if length >= depth or number[-1] == n - 1:
            break
        second = np.zeros(n, np.uint64)         # nothing follows: before all others
        if length < n:
            second[:-length] = rank[length:] + np.uint64(1)
        packed = np.sort((rank << np.uint64(43)) | (second << np.uint64(21)) | place)
        length *= 2
    where = np.empty(n, np.int64)
    where[sa] = np.arange(n)
    return sa, where, heads


def long_prefix_runs(text: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """(sa, run): neighbours in ``sa`` are in the same run if their suffixes
    share at least ``min_len`` bytes before an ``END``.

    Intervals of suffixes that begin with the same string w are extended to the
    left, breadth first: those that begin with cw, for every c before w in the
    transform, are an interval too. The right end of an interval found for
    |w| = l for the first time is a boundary with l - 1 bytes in common;
    boundaries come in order of that value. The rounds start with the intervals
    of the first bytes, known from sorting, and stop at ``min_len``: ends not
    found by then have at least ``min_len`` bytes in common.
    """
    n = len(text)
    sa, where, heads = suffix_ranks(text, min_len + 1)
    before = text[sa - 1]                       # the transform; text[-1] ends a string, as does text[n - 1]
    target = where[sa - 1]                      # where the suffix one byte longer stands
    found = np.zeros(n + 1, bool)
    found[0] = found[n] = True
    found[heads] = True
    start = heads
    stop = np.concatenate([heads[1:], [n]])
    for _ in range(FIRST + 1, min_len + 1):
        size = stop - start
        total = int(size.sum())
        if not total:
            break
        parent = np.repeat(np.arange(len(start)), size)
        at = np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)
        c = before[at]
        ok = c != END
        # children are runs of targets with the same parent and the same byte
        packed = np.sort((target[at[ok]].astype(np.uint64) << np.uint64(29)) | (parent[ok].astype(np.uint64) << np.uint64(8)) | c[ok])
        if not len(packed):
            break
        q = (packed >> np.uint64(29)).astype(np.int64)
        mark = packed & np.uint64((1 << 29) - 1)
        last = np.concatenate([(q[1:] != q[:-1] + 1) | (mark[1:] != mark[:-1]), [True]])
        first = np.concatenate([[True], last[:-1]])
        start, stop = q[first], q[last] + 1
        new = ~found[stop]
        found[stop[new]] = True
        # a run's left end is the right end of what stands before it, found on its own
        start, stop = start[new], stop[new]
    return sa, np.cumsum(found[:n]) - 1
