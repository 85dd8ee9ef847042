"""Quantiles of the standard normal distribution as column expressions.

Rational approximations in three regions of the probability (Wichura's algorithm AS 241, relative
error about 1e-16): near the middle in ``0.180625 - (p - 0.5)^2``, in the tails in the root of minus the
logarithm of the tail's probability.  One expression text serves Spark and the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerator and denominator coefficients of AS 241 (PPND16), lowest power first.
MIDDLE = ([3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
           4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
          [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
           2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3])
TAIL = ([1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
        [1.0, 2.05319162663775882187e0, 1.67638483018383804940e0, 6.89767334985100004550e-1,
         1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
FAR_TAIL = ([6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
             2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
            [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
             7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])
MIDDLE_HALF_WIDTH, MIDDLE_OFFSET, TAIL_OFFSET, FAR = 0.425, 0.180625, 1.6, 5.0


def _ratio(coefficients: tuple[list[float], list[float]], x: str) -> str:
    def horner(c: list[float]) -> str:
        out = f"{c[-1]:.20e}"
        for v in reversed(c[:-1]):
            out = f"({out} * {x} + {v:.20e})"
        return out

    return f"{horner(coefficients[0])} / {horner(coefficients[1])}"


def inverse_normal_sql(p: str) -> str:
    """SQL text (Spark and DuckDB) of the normal quantile of the double expression ``p`` in (0, 1), else null."""
    q = f"({p} - 5e-1)"
    r = f"({MIDDLE_OFFSET:e} - {q} * {q})"
    s = f"sqrt(-ln(least({p}, 1e0 - {p})))"
    return (f"CASE WHEN {p} > 0e0 AND {p} < 1e0 THEN CASE WHEN abs{q} <= {MIDDLE_HALF_WIDTH:e} THEN {q} * {_ratio(MIDDLE, r)} "
            f"ELSE sign{q} * (CASE WHEN {s} <= {FAR:e} THEN {_ratio(TAIL, f'({s} - {TAIL_OFFSET:e})')} "
            f"ELSE {_ratio(FAR_TAIL, f'({s} - {FAR:e})')} END) END END")


def inverse_normal(p: str) -> Column:
    """The normal quantile of a double column, null outside (0, 1)."""
    return F.expr(inverse_normal_sql(f"`{p}`"))
