"""A minimal acyclic transducer from words to ordinals.

The words' bytes are the paths of an automaton whose equal suffixes share
states. Every transition carries the number of words that sort before its
branch, so the sum along a word's path is the word's rank in sorted order;
the caller keeps an output for each rank. The automaton is four flat arrays,
so it can be written to a file and memory-mapped.
"""

from __future__ import annotations

import os

import numpy as np

MAX_BYTES = 48


def build(words: list[bytes]) -> dict[str, np.ndarray]:
    """Compile sorted distinct words, adding one at a time and merging each
    finished suffix with an equal state (the registry) at once."""
    registry: dict[tuple, int] = {}
    states: list[tuple] = []        # of each state: (final, ((byte, target), ...))

    def close(node) -> int:
        key = (node[0], tuple(node[1]))
        found = registry.get(key)
        if found is None:
            found = registry[key] = len(states)
            states.append(key)
        return found

    path = [[False, []]]            # open states along the last word
    last = b""
    for word in words:
        common = len(os.path.commonprefix((last, word)))
        for k in range(len(last), common, -1):
            target = close(path.pop())
            path[-1][1].append((last[k - 1], target))
        for _ in range(len(word) - common):
            path.append([False, []])
        path[-1][0] = True
        last = word
    for k in range(len(last), 0, -1):
        target = close(path.pop())
        path[-1][1].append((last[k - 1], target))
    root = close(path.pop())

    below = [0] * len(states)       # targets are closed before their sources
    keys, targets, before = [], [], []
    for s, (final, edges) in enumerate(states):
        n = int(final)
        for byte, target in edges:
            keys.append(s * 256 + byte)
            targets.append(target)
            before.append(n)
            n += below[target]
        below[s] = n
    return {"keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32),
            "before": np.array(before, np.int32),
            "final": np.array([s[0] for s in states], np.uint8),
            "root": np.array([root], np.int32)}


def save(path: str, arrays: dict[str, np.ndarray]) -> list[tuple]:
    """Write the arrays one after the other; the layout ``load`` needs."""
    layout, at = [], 0
    with open(path, "wb") as f:
        for name, a in arrays.items():
            pad = -at % 8
            f.write(b"\0" * pad + a.tobytes())
            layout.append((name, a.dtype.str, len(a), at + pad))
            at += pad + a.nbytes
    return layout


def load(path: str, layout: list[tuple]) -> dict[str, np.ndarray]:
    mapped = np.memmap(path, np.uint8, "r")
    return {name: mapped[at:at + n * np.dtype(kind).itemsize].view(kind)
            for name, kind, n, at in layout}


def ranks(lex: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Rank of each word, -1 where it isn't in the lexicon. All words walk the
    automaton together, one byte at a time."""
    out = np.full(len(words), -1, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    alive = np.flatnonzero((lengths > 0) & (lengths <= MAX_BYTES))
    if not len(alive) or not len(lex["keys"]):
        return out
    data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths
    state = np.full(len(alive), lex["root"][0], np.int64)
    rank = np.zeros(len(alive), np.int64)
    keys, targets, before, final = (np.asarray(lex[k]) for k in ("keys", "targets", "before", "final"))
    for col in range(MAX_BYTES + 1):
        ended = lengths[alive] == col
        hit = ended & (final[state] == 1)
        out[alive[hit]] = rank[hit]
        go = np.flatnonzero(~ended)
        if not len(go):
            break
        alive = alive[go]
        key = state[go] * 256 + data[starts[alive] + col]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        found = np.flatnonzero(keys[at] == key)
        alive, at, go = alive[found], at[found], go[found]
        state, rank = targets[at].astype(np.int64), rank[go] + before[at]
    return out
