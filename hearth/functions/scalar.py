"""Scalar column transforms (E1-E3, B6, B7, E14) and deterministic draws."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log1p(c: Column | str) -> Column:
    """ln(1 + x): skew removal applied to label and area features."""
    return F.log1p(_c(c))


def expm1(c: Column | str) -> Column:
    """e^x - 1: back-transform of a log1p-scale prediction."""
    return F.expm1(_c(c))


def log_positive(c: Column | str) -> Column:
    """ln(x) where x > 0, x unchanged otherwise (E3: zero basements)."""
    x = _c(c)
    return F.when(x > 0, F.log(x)).otherwise(x)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null when den is 0 or null (B6; ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def rescale(c: Column | str, factor: float) -> Column:
    """x / factor (B7: label in thousands)."""
    return _c(c) / F.lit(float(factor))


def unit_hash(c: Column | str, seed: int) -> Column:
    """Uniform draw in [0, 1) from a key and a seed via xxhash64.

    Stable under any partitioning or re-execution, so splits and samples
    built on it survive executor loss and give the same rows every run.
    """
    h = F.xxhash64(_c(c), F.lit(int(seed)))
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


_MASK31 = 0x7FFFFFFF
# Multipliers of the integer mix (the classic LCG constant
# 1103515245 and the MINSTD constant 48271).
_MIX_A = 1103515245
_MIX_B = 48271


def mix_unit(c: Column | str, seed: int) -> Column:
    """Uniform draw in [0, 1) from an integer key: multiply/xor-shift mix
    on 31 bits, into which the key's higher bits are folded first, so keys
    2^31 apart draw independently (non-negative keys).

    Pure 64-bit integer arithmetic with no overflow, so an SQL engine can
    reproduce it exactly (see :func:`mix_unit_sql`); used where an oracle
    must check which rows a random split or sample selects.
    """
    m = F.lit(_MASK31)
    key = _c(c).cast("long")
    high = F.shiftright(key, 31).bitwiseAND(m)
    # 0 for keys below 2^31; else a mix of its own
    fold = (high * F.lit(_MIX_B)).bitwiseAND(m)
    fold = ((fold.bitwiseXOR(F.shiftright(fold, 14)) + F.shiftright(key, 62)) * F.lit(_MIX_A)).bitwiseAND(m)
    h = (key.bitwiseAND(m) + fold + F.lit(int(seed))).bitwiseAND(m)
    h = (h * F.lit(_MIX_A) + F.lit(12345)).bitwiseAND(m)
    h = h.bitwiseXOR(F.shiftright(h, 15))
    h = (h * F.lit(_MIX_B)).bitwiseAND(m)
    h = h.bitwiseXOR(F.shiftright(h, 13))
    h = (h * F.lit(_MIX_A)).bitwiseAND(m)
    h = h.bitwiseXOR(F.shiftright(h, 16))
    return h.cast("double") / float(1 << 31)


def mix_number(key: int, seed: int) -> float:
    """:func:`mix_unit` of one number, on the driver."""
    high = (key >> 31) & _MASK31
    fold = high * _MIX_B & _MASK31
    fold = ((fold ^ fold >> 14) + (key >> 62)) * _MIX_A & _MASK31
    h = ((key & _MASK31) + fold + seed) & _MASK31
    h = (h * _MIX_A + 12345) & _MASK31
    h = (h ^ h >> 15) * _MIX_B & _MASK31
    h = (h ^ h >> 13) * _MIX_A & _MASK31
    return (h ^ h >> 16) / float(1 << 31)


def mix_unit_sql(col_sql: str, seed: int) -> str:
    """SQL text (DuckDB dialect) of :func:`mix_unit`."""
    key = f"(({col_sql})::BIGINT)"
    fold = f"((({key} >> 31) & {_MASK31}) * {_MIX_B} & {_MASK31})"
    fold = f"((xor({fold}, {fold} >> 14) + ({key} >> 62)) * {_MIX_A} & {_MASK31})"
    h = f"((({key} & {_MASK31}) + {fold} + {int(seed)}) & {_MASK31})"
    h = f"(({h} * {_MIX_A} + 12345) & {_MASK31})"
    h = f"xor({h}, {h} >> 15)"
    h = f"(({h}) * {_MIX_B} & {_MASK31})"
    h = f"xor({h}, {h} >> 13)"
    h = f"(({h}) * {_MIX_A} & {_MASK31})"
    h = f"xor({h}, {h} >> 16)"
    return f"(({h})::DOUBLE / {1 << 31})"


def count_below(c: Column | str, sorted_values, inclusive: bool = False) -> Column:
    """How many of ``sorted_values`` are < x (or <= x when ``inclusive``),
    as a balanced tree of comparisons: about log2(len) comparisons per row
    instead of one per value. Null stays null."""
    x = _c(c)
    vals = [float(v) for v in sorted_values]

    def below(v):
        return (F.lit(v) <= x) if inclusive else (F.lit(v) < x)

    def build(lo: int, hi: int) -> Column:
        # count over vals[lo:hi], knowing the answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(vals[mid]), build(mid + 1, hi)).otherwise(build(lo, mid))

    return F.when(x.isNotNull(), build(0, len(vals)))
