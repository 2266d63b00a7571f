"""Operator 11 against brute force, and its query against the contract read word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from hearth.llm import QUERIES, runs
from tests.conftest import SF0001
from tests.llm.conftest import AWKWARD


def slow_lyndon(s):
    out = []
    for i in range(len(s)):
        words = [s[i:j] for j in range(i + 1, len(s) + 1)]
        out.append(max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return out


def slow_runs(s, min_length, min_exponent):
    out = []
    for q in range(1, len(s) // min_exponent + 1):
        k = 0
        while k + q < len(s):
            a = k
            while k + q < len(s) and s[k] == s[k + q]:
                k += 1
            n = k - a + q
            k += k == a
            if n >= max(min_length, min_exponent * q) and not any(
                    all(s[x] == s[x + d] for x in range(a, a + n - d)) for d in range(1, q)):
                out.append((a, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_match_their_definition():
    rng = random.Random(3)
    for _ in range(400):
        s = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(25))]
        assert runs.lyndon_lengths(s) == slow_lyndon(s)
        assert runs.lyndon_lengths([-x for x in s]) == slow_lyndon([-x for x in s])


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (5, 3)])
def test_runs_match_brute_force(limits):
    rng = random.Random(4)
    for _ in range(700):
        s = []
        for _ in range(rng.randrange(5)):
            u = [rng.randrange(rng.choice([2, 3])) for _ in range(rng.randrange(1, 6))]
            s += u * rng.randrange(1, 7) + u[:rng.randrange(len(u) + 1)]
        want = slow_runs(s, *limits)
        if s:
            assert runs.find_runs(np.array(s), *limits) == want
        # the same through the chunk's cut into stretches, between rare words and other documents
        text = [b"%d" % x for x in s]
        shifted = [(a + 2, n, q) for a, n, q in want]
        got = runs.chunk_runs([text, [b"x", b"y", *text, b"z"], []], *limits)
        assert got[0] == want and got[2] == []
        if limits == (6, 4):
            assert got[1] == shifted


def test_common_extension():
    x = np.array([1, 2, 1, 2, 1, 2, 3] * 40)
    for i in range(0, 40):
        for j in range(i + 1, 60):
            n = 0
            while j + n < len(x) and x[i + n] == x[j + n]:
                n += 1
            assert runs.common_extension(x, i, j) == n


def test_periodic_runs_edges(spark, awkward, empty):
    rows = {r.n: r for r in runs.periodic_runs(awkward).select("row.n", "n_words", "runs", "collapsed").collect()}
    assert len(rows) == len(AWKWARD)
    for k, (_, text) in enumerate(AWKWARD):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert rows[k].n_words == len(words)
        if len(words) == 60_000:
            assert [tuple(r) for r in rows[k].runs] == [(0, 60_000, 1)] and rows[k].collapsed == "word"
        else:
            assert [tuple(r) for r in rows[k].runs] == slow_runs(words, 6, 4)
    assert runs.periodic_runs(empty).count() == 0


def test_query_reads_as_the_contract(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF0001).collect()}
    assert set(got) == set(texts)
    found = 0
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want = slow_runs(words, 6, 4) if n < 1500 else [tuple(r) for r in slow_long(words)]
        keep = [True] * n
        for a, m, q in want:
            keep[a + q:a + m] = [False] * (m - q)
        r = got[doc]
        assert r.n_runs == len(want)
        top = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None, None, None)
        assert (r.start, r.length, r.period) == top
        assert r.exponent_milli == (1000 * top[1] // top[2] if want else None)
        lines = "".join(f"{a},{m},{q}\n" for a, m, q in want)
        kept = " ".join(w for w, k in zip(words, keep) if k)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        found += len(want)
    assert found > 0


def slow_long(words):
    """The same by numpy, period by period, for long texts."""
    x = np.unique(words, return_inverse=True)[1]
    out = []
    for q in range(1, len(x) // 4 + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        edge = np.flatnonzero(np.diff(same.astype(int)))
        for a, b in zip(edge[::2], edge[1::2]):
            n = int(b - a) + q
            if n >= max(6, 4 * q) and not any((x[a:a + n - d] == x[a + d:a + n]).all() for d in range(1, q)):
                out.append((int(a), n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))
