"""Student t and F tail probabilities for OLS inference.

These are driver-side scalars computed from a handful of aggregate values,
so a small pure-Python regularised incomplete beta is enough and works the
same on classic and Connect sessions.
"""

from __future__ import annotations

import math


def _betacf(a: float, b: float, x: float) -> float:
    # Modified Lentz evaluation of the continued fraction for I_x(a, b).
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def reg_inc_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _betacf(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _betacf(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    """P(T <= t) for Student's t with ``df`` degrees of freedom."""
    if df <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 1.0 if t > 0 else 0.0
    tail = 0.5 * t_two_sided_p(t, df)
    return 1.0 - tail if t > 0 else tail


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|). Many degrees of freedom cancel in the beta function's
    logarithms, so there t becomes the normal deviate of the same tail."""
    if df <= 0 or t is None or math.isnan(t):
        return float("nan")
    if df >= 1000.0:
        c = df - 0.5
        z = math.sqrt(c * math.log1p(t * t / df)) if abs(t) < 1e150 else abs(t)
        z += (z ** 3 + 3.0 * z) / (48.0 * c * c) if z < 40.0 else 0.0
        return math.erfc(z / math.sqrt(2.0))
    x = df / (df + t * t)
    return reg_inc_beta(df / 2.0, 0.5, x)


def t_quantile(p: float, df: float) -> float:
    """Inverse of :func:`t_cdf` by bisection on a bracketing interval."""
    if df <= 0 or not 0.0 < p < 1.0:
        return float("nan")
    if p == 0.5:
        return 0.0
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > p:
        lo *= 2.0
    while t_cdf(hi, df) < p:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-14 * max(1.0, abs(mid)):
            break
    return 0.5 * (lo + hi)


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F(d1, d2) distribution."""
    if d1 <= 0 or d2 <= 0 or f is None or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    if d1 == 1:
        return t_two_sided_p(math.sqrt(f), d2)
    return reg_inc_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
