"""Special functions Spark SQL lacks (complementary error function, log-gamma,
incomplete gamma and the chi-square survival function) as Column expressions:
power series and continued fractions folded with ``aggregate`` over a bounded
number of terms. ``chi2_sf_value`` is the plain-Python form the tests compare
them with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE_A = 1e6


def _gamma_q_large(a: float, x: float) -> float:
    """Leading terms of the uniform expansion of Q(a, x); the error is below
    1/a of the value's scale."""
    d = (x - a) / a
    if abs(d) < 1e-3:  # the series of eta around x = a
        eta = d * (1 - d / 3 + 7 * d * d / 36 - 73 * d ** 3 / 540)
        c0 = -1 / 3 + eta / 12
    else:
        eta = math.copysign(math.sqrt(2 * (d - math.log1p(d))), d)
        c0 = 1 / d - 1 / eta
    tail = 0.5 * math.erfc(eta * math.sqrt(a / 2))
    return min(1.0, max(0.0, tail + math.exp(-a * eta * eta / 2) / math.sqrt(2 * math.pi * a) * c0))


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a+1, continued
    fraction (modified Lentz) above, both until they have converged (about
    sqrt(a) terms); for very large a the uniform asymptotic form."""
    if x < 0 or a <= 0:
        return float("nan")
    if x == 0:
        return 1.0
    if a > LARGE_A:
        return _gamma_q_large(a, x)
    lg = math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        while abs(term) >= abs(total) * 1e-16:
            ap += 1
            term *= x / ap
            total += term
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - lg))
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    i, delta = 0, 0.0
    while abs(delta - 1) >= 4e-16:
        i += 1
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
    return math.exp(-x + a * math.log(x) - lg) * h


def chi2_sf_value(x: float, dof: float) -> float:
    if x is None or dof is None or math.isnan(x) or math.isnan(dof):
        return float("nan")
    return _gamma_q(dof / 2.0, x / 2.0)


def _terms(a: Column) -> Column:
    """Enough terms for the series and the continued fraction of Q(a, x): their
    ratio falls below 1e-17 after about 9·sqrt(a) of them. Bounded by LARGE_A."""
    return (100 + 12 * F.sqrt(F.least(a, F.lit(LARGE_A)))).cast("int")


def _sum_of_terms(n: Column, first: Column, ratio) -> Column:
    """first·(1 + r1 + r1·r2 + …), n ratios."""
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * ratio(k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(F.sequence(F.lit(1), n), start, add)["total"]


def erfc(x: Column) -> Column:
    """Complementary error function: power series of erf below 2, continued
    fraction (evaluated from its 120th level up) from there."""
    a = F.abs(x)
    low, high = F.least(a, F.lit(2.0)), F.greatest(a, F.lit(2.0))
    erf = 2 / math.sqrt(math.pi) * F.exp(-low * low) * _sum_of_terms(
        F.lit(60), low, lambda k: 2 * low * low / (2 * k + 1))
    levels = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), high, lambda acc, k: high + k / 2 / acc)
    v = F.when(a < 2, 1 - erf).otherwise(F.exp(-high * high) / math.sqrt(math.pi) / levels)
    return F.when(x < 0, 2 - v).when(x.isNotNull(), v)  # least and greatest pass over nulls


def lgamma(a: Column) -> Column:
    """ln Γ(a), a > 0: Stirling's series at a + 8, stepped back to a."""
    z = a + 8
    back = F.lit(0.0)
    for i in range(8):
        back = back + F.log(a + i)
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
            + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0)))
            + 1 / (1188 * F.pow(z, F.lit(9.0)))) - back


def gamma_q(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued
    fraction above, the uniform asymptotic form for very large a. Null for null
    arguments, NaN outside the domain."""
    small = F.least(a, F.lit(LARGE_A))  # the unused branches must stay finite
    scale = F.exp(-x + a * F.log(x) - lgamma(a))
    low, high = F.least(x, small + 1), F.greatest(x, small + 1)
    series = 1 - scale * _sum_of_terms(_terms(a), 1 / small, lambda k: low / (small + k))
    n = _terms(a)
    levels = F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), high + 2 * n + 1 - small,
                         lambda acc, k: high + 2 * k - 1 - small - k * (k - small) / acc)
    d = (x - a) / a
    near = d * (1 - d / 3 + 7 * d * d / 36 - 73 * d * d * d / 540)
    far = F.signum(d) * F.sqrt(2 * (d - F.log1p(d)))
    is_near = F.abs(d) < 1e-3
    eta = F.when(is_near, near).otherwise(far)
    c0 = F.when(is_near, -1 / 3 + near / 12).otherwise(F.try_divide(F.lit(1.0), d) - F.try_divide(F.lit(1.0), far))
    large = 0.5 * erfc(eta * F.sqrt(a / 2)) + F.exp(-a * eta * eta / 2) / F.sqrt(2 * math.pi * a) * c0
    q = F.when(a > LARGE_A, large).when(x < a + 1, series).otherwise(scale / levels)
    return (F.when(a.isNull() | x.isNull(), F.lit(None))
            .when((x < 0) | (a <= 0) | F.isnan(x) | F.isnan(a), F.lit(float("nan")))
            .when(x == 0, F.lit(1.0))
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))))


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > x)."""
    return gamma_q(dof.cast("double") / 2, x.cast("double") / 2)


def normal_two_sided_p(z: Column) -> Column:
    """2·P(Z > |z|) = erfc(|z|/√2)."""
    return erfc(F.abs(z) / math.sqrt(2.0))
