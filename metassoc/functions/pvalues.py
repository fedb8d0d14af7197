"""Two-sided p-values as native column expressions, with full relative precision far out (p = 1e-300 stays 1e-300).

Spark SQL has neither erf nor the incomplete beta function.  Both tails are continued fractions, evaluated from the last
step back by one ``aggregate`` over a constant array of step numbers; what lies near the centre is one minus a
convergent series or the mirrored fraction.

Student t with ν degrees of freedom: with x = ν/(ν + t²), p is the incomplete beta function I_x(ν/2, 1/2).  In logarithms

    p = exp(-ν/2 · log(1 + t²/ν) + log(1 - x)/2 + log(Γ(a + 1/2) / (Γ(a) √π))) / (ν/2) / fraction,   a = ν/2,

and Γ(a + 1/2)/Γ(a) comes from its asymptotic series at a + ``SHIFT``, stepped down by Γ(z + 1) = zΓ(z).  ``STEPS`` steps suffice
for any ν: the fraction is used where t² > 3 or so, its mirror image elsewhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 120
SHIFT = 24
# fixed values: series of Γ(c + 1/2) / (Γ(c) √c) in powers of 1/c
GAMMA_RATIO = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304, 39325 / 33554432)


def _back(steps: int, start: Column, step) -> Column:
    """start, then step(k, value) for k = steps down to 1."""
    return F.aggregate(F.sequence(F.lit(steps), F.lit(1), F.lit(-1)), start, lambda acc, k: step(k.cast("double"), acc))


def _square(c: Column) -> Column:
    return c * c


def gamma_ratio(a: Column) -> Column:
    """Γ(a + 1/2) / Γ(a) for a > 0."""
    c = a + float(SHIFT)
    series = F.lit(GAMMA_RATIO[-1])
    for coefficient in reversed(GAMMA_RATIO[:-1]):
        series = series / c + F.lit(coefficient)
    steps = F.sequence(F.lit(0), F.lit(SHIFT - 1))
    down = F.aggregate(steps, F.lit(1.0), lambda acc, k: acc * (a + k) / (a + k + 0.5))
    return down * F.sqrt(c) * series


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """1 + d1/(1 + d2/(1 + …)) with d(2m) = m(b - m)x / ((a + 2m - 1)(a + 2m)) and
    d(2m + 1) = -(a + m)(a + b + m)x / ((a + 2m)(a + 2m + 1))."""
    def step(k, value):
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + k - 1.0) * (a + k))
        odd = -(a + m) * (a + b + m) * x / ((a + k - 1.0) * (a + k))
        return F.when(k == 2.0 * m, even).otherwise(odd) / value + 1.0
    return _back(STEPS, F.lit(1.0), step)


def _p_student(t: Column, df: Column) -> Column:
    a, t2 = df / 2.0, _square(t)
    x, y = df / (df + t2), t2 / (df + t2)
    central = x > (a + 1.0) / (a + 2.5)
    p, q, v = F.when(central, F.lit(0.5)).otherwise(a), F.when(central, a).otherwise(F.lit(0.5)), F.when(central, y).otherwise(x)
    scale = F.exp(-a * F.log1p(t2 / df) + F.log(y) / 2.0) * gamma_ratio(a) / math.sqrt(math.pi)
    part = scale / (p * _beta_fraction(p, q, v))
    found = F.when(t2 == 0.0, F.lit(1.0)).when(central, 1.0 - part).otherwise(part)
    return F.when(t.isNotNull() & ~F.isnan(t) & ~F.isnan(df) & (df > 0), F.when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(found))


def _p_normal(t: Column) -> Column:
    """erfc(|t|/√2): below 2, one minus a series of positive terms; from there on Laplace's continued fraction."""
    v = F.abs(t) / math.sqrt(2.0)
    v2 = v * v
    near = 1.0 - 2.0 / math.sqrt(math.pi) * F.exp(-v2) * v * _back(60, F.lit(1.0), lambda k, s: s * 2.0 * v2 / (2.0 * k + 1.0) + 1.0)
    far = F.exp(-v2) / (math.sqrt(math.pi) * _back(STEPS, v, lambda k, s: v + k / 2.0 / s))
    found = F.when(v < 2.0, near).when(v == float("inf"), F.lit(0.0)).otherwise(far)
    return F.when(t.isNotNull() & ~F.isnan(t), found)


def p_value(t, df=None) -> Column:
    """Two-sided p for a t statistic: Student t with ``df`` when given, standard normal otherwise; null for null or NaN
    and for df <= 0."""
    t = (F.col(t) if isinstance(t, str) else t).cast("double")
    if df is None:
        return _p_normal(t)
    return _p_student(t, (F.col(df) if isinstance(df, str) else df).cast("double"))
