"""Standard normal CDF and its inverse as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Coefficients of P. J. Acklam's published rational
# approximation of the inverse normal CDF (relative error < 1.15e-9).
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_P_LOW = 0.02425


def _horner(coefs, x):
    acc = F.lit(coefs[0])
    for k in coefs[1:]:
        acc = acc * x + F.lit(k)
    return acc


def inverse_normal_cdf(p: Column | str) -> Column:
    """Quantile function of N(0, 1); null outside (0, 1)."""
    p = F.col(p) if isinstance(p, str) else p
    q = p - 0.5
    r = q * q
    central = _horner(ACKLAM_A, r) * q / (_horner(ACKLAM_B, r) * r + 1.0)
    ql = F.sqrt(-2.0 * F.log(p))
    lower = _horner(ACKLAM_C, ql) / (_horner(ACKLAM_D, ql) * ql + 1.0)
    qu = F.sqrt(-2.0 * F.log(1.0 - p))
    upper = -_horner(ACKLAM_C, qu) / (_horner(ACKLAM_D, qu) * qu + 1.0)
    return (F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
            .when(p < ACKLAM_P_LOW, lower)
            .when(p > 1 - ACKLAM_P_LOW, upper)
            .otherwise(central))


def inverse_normal_cdf_sql(p: str) -> str:
    """The same approximation as SQL text (for oracles)."""
    def horner(coefs, x):
        s = repr(coefs[0])
        for k in coefs[1:]:
            s = f"({s}) * ({x}) + {k!r}"
        return s
    q = f"(({p}) - 0.5)"
    r = f"({q} * {q})"
    central = f"({horner(ACKLAM_A, r)}) * {q} / (({horner(ACKLAM_B, r)}) * {r} + 1.0)"
    ql = f"sqrt(-2.0 * ln({p}))"
    lower = f"({horner(ACKLAM_C, ql)}) / (({horner(ACKLAM_D, ql)}) * {ql} + 1.0)"
    qu = f"sqrt(-2.0 * ln(1.0 - ({p})))"
    upper = f"-({horner(ACKLAM_C, qu)}) / (({horner(ACKLAM_D, qu)}) * {qu} + 1.0)"
    return (f"(CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL "
            f"WHEN ({p}) < {ACKLAM_P_LOW} THEN {lower} "
            f"WHEN ({p}) > {1 - ACKLAM_P_LOW} THEN {upper} ELSE {central} END)")


def normal_cdf(z: Column | str) -> Column:
    """Phi(z) via erf-free identity Phi(z) = 0.5 * erfc(-z / sqrt 2).

    Spark has no erf; uses the Abramowitz-Stegun 7.1.26 form (|err| < 1.5e-7).
    """
    z = F.col(z) if isinstance(z, str) else z
    x = F.abs(z) / 1.4142135623730951
    t = 1.0 / (1.0 + 0.3275911 * x)
    # Abramowitz & Stegun 7.1.26 coefficients.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * F.exp(-x * x)
    return F.when(z >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))
