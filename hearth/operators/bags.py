"""The draws of Spark ML's forests, made in numpy.

A forest's bags are Poisson counts, one per row and tree, that commons-math draws
from one WELL19937c generator per partition; a node's features come from an
XORShift generator. Both are followed here bit by bit, so a forest grown outside
Spark ML (:mod:`hearth.operators.binned_trees`) is the same forest.

The generator is linear over GF(2): its state ``j`` steps on is the sum of the
states at the powers of ``x^j`` modulo its characteristic polynomial. So a long
stream is cut into lanes, each started by such a jump, which step together.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

_WORDS, _DEGREE = 624, 19937
_M = 0xFFFFFFFF


# ---------------------------------------------------------------- WELL19937c

def _seeded(seed: int) -> np.ndarray:
    """The 624 words of a generator seeded with a long."""
    v = [(seed >> 32) & _M, seed & _M]
    for i in range(2, _WORDS):
        word = v[i - 2]
        signed = word - (1 << 32) if word >> 31 else word
        v.append((1812433253 * (signed ^ (signed >> 30)) + i) & _M)
    return np.array(v, np.uint32)


class _Lanes:
    """Generators that step together. ``past`` (623 rows, oldest first) holds the
    words ``z3`` of the last steps and ``z4`` the last step's other word, of
    which the outputs are made."""

    def __init__(self, past: np.ndarray, z4: np.ndarray):
        self.past, self.z4 = past, z4

    @classmethod
    def seeded(cls, seed: int) -> "_Lanes":
        v = _seeded(seed)
        return cls(v[:0:-1, None].copy(), v[:1].copy())

    def run(self, steps: int, keep_words: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The next (steps x lanes) raw words ``z4``; with ``keep_words`` also ``z3``."""
        lanes = self.past.shape[1]
        z3 = np.empty((_WORDS - 1 + (steps if keep_words else min(steps, 4096)), lanes), np.uint32)
        z3[:_WORDS - 1] = self.past
        out = np.empty((steps, lanes), np.uint32)
        last, low, high = self.z4.copy(), np.uint32(0x7FFFFFFF), np.uint32(0x80000000)
        t, done = _WORDS - 1, 0
        z1, tmp = np.empty(lanes, np.uint32), np.empty(lanes, np.uint32)
        left, xor, right = np.left_shift, np.bitwise_xor, np.right_shift
        while done < steps:
            if t == len(z3):                  # only the last words are needed
                z3[:_WORDS - 1] = z3[t - _WORDS + 1:].copy()
                t = _WORDS - 1
            n = min(70, steps - done, len(z3) - t)
            m1, m2, m3 = z3[t - 70:t - 70 + n], z3[t - 179:t - 179 + n], z3[t - 449:t - 449 + n]
            z0 = (high & z3[t - 623:t - 623 + n]) ^ (low & z3[t - 622:t - 622 + n])
            k1 = m1 ^ (m1 >> 27)
            z2 = (m2 >> 9) ^ (m3 ^ (m3 >> 1))
            k2 = z0 ^ (z2 << 21) ^ (z2 >> 21)
            words, here = z3[t:t + n], out[done:done + n]
            for s in range(n):
                left(last, 25, out=tmp)
                xor(tmp, last, out=tmp)
                z1 = words[s]
                xor(tmp, k1[s], out=z1)
                last = here[s]
                left(z1, 9, out=last)
                right(z1, 21, out=tmp)
                xor(last, tmp, out=last)
                xor(last, k2[s], out=last)
            words ^= z2                       # held z1
            t, done = t + n, done + n
        self.past, self.z4 = z3[t - _WORDS + 1:t].copy(), last.copy()
        return out, z3 if keep_words else None

    def jumped(self, power: int) -> "_Lanes":
        """The same generators at the steps whose polynomial is ``power``."""
        before = _Lanes(self.past, self.z4)
        z4, z3 = before.run(_DEGREE, keep_words=True)
        z4 = np.concatenate([self.z4[None], z4])
        past, last = np.zeros_like(self.past), np.zeros_like(self.z4)
        for i, bit in enumerate(reversed(bin(power)[2:])):
            if bit == "1":
                past ^= z3[i:i + _WORDS - 1]
                last ^= z4[i]
        return _Lanes(past, last)


def _outputs(z4: np.ndarray) -> np.ndarray:
    """Tempered words."""
    z4 = z4 ^ ((z4 << 7) & np.uint32(0xE46E1700))
    return z4 ^ ((z4 << 15) & np.uint32(0x9B868000))


@lru_cache(maxsize=1)
def _characteristic() -> int:
    """The generator's characteristic polynomial, from one bit of its outputs
    (Berlekamp and Massey); bit k is the coefficient of x^k."""
    lanes = _Lanes.seeded(1)
    lanes.run(_WORDS)
    bits = (lanes.run(2 * _DEGREE + 64)[0][:, 0] & 1).tolist()
    c, b, length, shift, seen = 1, 1, 0, 1, 0
    for n, bit in enumerate(bits):
        seen = seen << 1 | bit
        if (seen & c).bit_count() & 1:
            if 2 * length <= n:
                c, b, length, shift = c ^ (b << shift), c, n + 1 - length, 1
                continue
            c ^= b << shift
        shift += 1
    return int(bin(c)[2:].zfill(length + 1)[::-1], 2)


@lru_cache(maxsize=64)
def _power(k: int) -> int:
    """x^(2^k) modulo the characteristic polynomial."""
    if k == 0:
        return 2
    p = _characteristic()
    square = int(bin(_power(k - 1))[2:], 4)   # squaring spreads the bits
    while square.bit_length() > _DEGREE:
        square ^= p << (square.bit_length() - 1 - _DEGREE)
    return square


#: words of a stream that are made by one generator alone, the steps of a lane after
#: them and the most lanes (powers of two), and the words that are handed on at once
ALONE, STEP_BITS, LANE_BITS, PIECE = 64_000, 16, 8, 1 << 20


def _words(seed: int, expected: int):
    """The generator's outputs, an even number at a time; ``expected`` only decides the number of lanes."""
    one = _Lanes.seeded(seed)
    for _ in range(8):
        yield _outputs(one.run(ALONE // 8)[0][:, 0])
    lanes = one
    bits = min(max((expected - ALONE) >> STEP_BITS, 1).bit_length(), LANE_BITS)
    for k in range(bits):                     # lane j starts j * 2^STEP_BITS steps on
        more, n = lanes.jumped(_power(STEP_BITS + bits - 1 - k)), lanes.past.shape[1]
        past, z4 = np.empty((_WORDS - 1, 2 * n), np.uint32), np.empty(2 * n, np.uint32)
        past[:, 0::2], past[:, 1::2], z4[0::2], z4[1::2] = lanes.past, more.past, lanes.z4, more.z4
        lanes = _Lanes(past, z4)
    while True:
        following = _Lanes(lanes.past, lanes.z4)
        words = following.run(1 << STEP_BITS)[0].T.reshape(-1)
        for at in range(0, len(words), PIECE):
            yield _outputs(words[at:at + PIECE])
        lanes = lanes.jumped(_power(STEP_BITS + bits))


# ---------------------------------------------------------------- Poisson counts

_P = math.exp(-1.0)


def _poisson(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts made of a stream of uniform draws, and the draws left over: a count
    is how many draws can be multiplied before the product is below 1/e."""
    counts = np.zeros(len(u), np.int32)
    live, r = np.flatnonzero(u >= _P), u[u >= _P]
    open_from = len(u)                        # the first start whose count is not known
    while len(live):
        counts[live] += 1
        inside = live + counts[live] < len(u)
        if not inside.all():
            open_from = min(open_from, int(live[~inside][0]))
            live, r = live[inside], r[inside]
        r = r * u[live + counts[live]]
        on = r >= _P
        live, r = live[on], r[on]
    after = np.append(np.minimum(np.arange(len(u)) + counts + 1, len(u)), len(u))
    stride, far = 64, after
    for _ in range(6):
        far = far[far]
    starts, at = [], 0
    while at < len(u):
        starts.append(at)
        at = int(far[at])
    at, chain = np.array(starts, np.int64), np.empty((len(starts), stride), np.int64)
    for k in range(stride):
        chain[:, k] = at
        at = after[at]
    chain = chain.reshape(-1)
    chain = chain[chain < open_from]
    end = int(after[chain[-1]]) if len(chain) else 0
    return counts[chain].astype(np.uint8), u[end:]


class PoissonStream:
    """Counts of mean 1 as ``PoissonDistribution`` draws them after
    ``reseedRandomGenerator(seed)``; about ``expected`` of them will be taken."""

    def __init__(self, seed: int, expected: int = 0):
        self._blocks = _words(seed, 4 * expected)
        self._rest = np.zeros(0)
        self._start, self._counts = 0, np.zeros(0, np.uint8)

    def take(self, start: int, stop: int) -> np.ndarray:
        """Counts ``start`` to ``stop``; a later call must not start before this one."""
        pieces, have = [self._counts], len(self._counts)
        while self._start + have < stop:
            words = next(self._blocks) >> np.uint32(6)
            u = (words[0::2].astype(np.int64) << 26 | words[1::2]) * 2.0 ** -52
            counts, self._rest = _poisson(np.concatenate([self._rest, u]))
            pieces.append(counts)
            have += len(counts)
        drop = min(max(start - self._start, 0), have)
        self._counts, self._start = np.concatenate(pieces)[drop:], self._start + drop
        return self._counts[start - self._start:stop - self._start]


# ---------------------------------------------------------------- features of nodes

def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


class JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self._state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def next_int(self) -> int:
        self._state = (self._state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self._state >> 16, 32)

    def next_long(self) -> int:
        return _signed((self.next_int() << 32) + self.next_int(), 64)


def _murmur(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & _M
        k = (k << 15 | k >> 17) & _M
        h ^= k * 0x1B873593 & _M
        h = ((h << 13 | h >> 19) & _M) * 5 + 0xE6546B64 & _M
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _M
    h = (h ^ h >> 13) * 0xC2B2AE35 & _M
    return h ^ h >> 16


class XorShift:
    """Spark's ``XORShiftRandom``."""

    def __init__(self, seed: int):
        data = (seed & (1 << 64) - 1).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        self._seed = _murmur(data, low) << 32 | low

    def next(self, bits: int) -> int:
        s = self._seed
        s ^= s << 21 & (1 << 64) - 1
        s ^= s >> 35
        s ^= s << 4 & (1 << 64) - 1
        self._seed = s
        return s & (1 << bits) - 1

    def next_int(self) -> int:
        return _signed(self.next(32), 32)

    def next_double(self) -> float:
        return ((self.next(26) << 27) + self.next(27)) * 2.0 ** -53


def drawn_features(n: int, k: int, seed: int) -> list[int]:
    """``k`` of ``n`` features (a reservoir), as Spark ML draws them for a node."""
    kept = list(range(k))
    if k < n:
        rand = XorShift(seed)
        for item in range(k, n):
            at = int(rand.next_double() * (item + 1))
            if at < k:
                kept[at] = item
    return kept


def _improved(h: int) -> int:
    h = h + ~(h << 9) & _M
    h ^= h >> 14
    h = h + (h << 4) & _M
    return h ^ h >> 10


def map_order(keys: list[int], shift: int = 0) -> list[int]:
    """The order in which Scala goes through an immutable map with these few
    non-negative keys, filled from a mutable one: as put in up to four, then by hash."""
    if shift == 0 and len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))
    at: dict[int, list[int]] = {}
    for k in keys:
        at.setdefault(_improved(k) >> shift & 31, []).append(k)
    alone = [at[b][0] for b in sorted(at) if len(at[b]) == 1]
    return alone + [k for b in sorted(at) if len(at[b]) > 1 for k in map_order(at[b], shift + 5)]
