"""Column expressions (JVM-side, codegen-friendly) and small scalar helpers."""

from hearth.functions.scalar import (log1p, expm1, log_positive, ratio,
                                     rescale, unit_hash, mix_unit)
from hearth.functions.normal import inverse_normal_cdf, normal_cdf
from hearth.functions.distributions import t_cdf, t_quantile, f_sf

__all__ = ["log1p", "expm1", "log_positive", "ratio", "rescale", "unit_hash",
           "mix_unit", "inverse_normal_cdf", "normal_cdf", "t_cdf",
           "t_quantile", "f_sf"]
