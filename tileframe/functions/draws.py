"""Reproducible random draws: the value depends only on a seed text, never on task or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unit_interval(hex_digits: Column) -> Column:
    """Eight hex digits to a double strictly inside (0, 1)."""
    return (F.conv(hex_digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**32))


def uniform(seed: Column) -> Column:
    return _unit_interval(F.substring(F.md5(seed), 1, 8))


# Fixed values of the published rational approximation AS 241 to the inverse of the normal distribution (16 digits),
# lowest power first: the middle, and the tails down to a chance of about 1e-11.
_MIDDLE = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3,
)
_MIDDLE_BELOW = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3,
)
_TAIL = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
    1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
_TAIL_BELOW = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
)
#: Share of a normal distribution that lies more than three deviations below its middle.
BELOW_THREE = 0.0013498980316300933


def _polynomial(x: Column, factors: tuple[float, ...]) -> Column:
    value = F.lit(factors[-1])
    for factor in factors[-2::-1]:
        value = value * x + F.lit(factor)
    return value


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution for chances between 1e-11 and 1 - 1e-11."""
    q = p - F.lit(0.5)
    r = F.lit(0.180625) - q * q
    middle = q * _polynomial(r, _MIDDLE) / _polynomial(r, _MIDDLE_BELOW)
    t = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p))) - F.lit(1.6)
    tail = F.signum(q) * _polynomial(t, _TAIL) / _polynomial(t, _TAIL_BELOW)
    return F.when(F.abs(q) <= 0.425, middle).otherwise(tail)


def normal_within_three(seed: Column) -> Column:
    """A draw from the standard normal distribution cut off at three deviations, by its inverse: one draw, no tries."""
    return normal_quantile(F.lit(BELOW_THREE) + F.lit(1 - 2 * BELOW_THREE) * uniform(seed))
