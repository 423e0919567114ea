"""Tail probabilities of t and F statistics as column expressions.

Both are regularised incomplete beta functions. Their continued fraction is a fold over a sequence of steps, evaluated for the
one row that a test gives; nothing leaves the JVM.
"""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300


def _num(value: Column | float) -> Column:
    return (value if isinstance(value, Column) else F.lit(float(value))).cast("double")


def _stirling_rest(z: Column) -> Column:
    """What Stirling's formula leaves of ln gamma, for z of 10 and more."""
    s = 1 / (z * z)
    return (F.lit(1 / 12) - s * (F.lit(1 / 360) - s * (F.lit(1 / 1260) - s * (F.lit(1 / 1680) - s / 1188)))) / z


def ln_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0; small arguments are shifted up by 10."""
    small = z < 10
    up = F.when(small, z + 10).otherwise(z)
    whole = (up - 0.5) * F.log(up) - up + 0.5 * log(2 * pi) + _stirling_rest(up)
    shift = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda s, k: s + F.log(z + k))
    return whole - F.when(small, shift).otherwise(F.lit(0.0))


def ln_beta(a: Column, b: Column) -> Column:
    """ln of the beta function. For a large argument the difference of two nearly equal gammas is taken term by term."""
    p, q = F.greatest(a, b), F.least(a, b)
    far = -(p - 0.5) * F.log1p(q / p) - q * F.log(p + q) + q + _stirling_rest(p) - _stirling_rest(p + q)
    return ln_gamma(q) + F.when(p < 10, ln_gamma(p) - ln_gamma(p + q)).otherwise(far)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction by Lentz's method; steps grow with the root of the larger argument."""

    def kept(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def half(s: Column, term: Column) -> Column:
        c, d = kept(1 + term / s.getField("c")), 1 / kept(1 + term * s.getField("d"))
        return state(c, d, s.getField("h") * c * d)

    def step(s: Column, k: Column) -> Column:
        m = k.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # A lambda's variable names the first half, so that it is computed once.
        return F.get(F.transform(F.array(half(s, even)), lambda first: half(first, odd)), F.lit(0))

    begin = 1 / kept(1 - (a + b) * x / (a + 1))
    steps = F.sequence(F.lit(1), (60 + 4 * F.sqrt(F.greatest(a, b))).cast("int"))
    return F.aggregate(steps, state(F.lit(1.0), begin, begin), step, lambda s: s.getField("h"))


def incomplete_beta(a: Column, b: Column, x: Column, rest: Column) -> Column:
    """Regularised incomplete beta function; ``rest`` is 1 - x, given apart so that no digits are lost near 1."""
    a, b, x, rest = (_num(v) for v in (a, b, x, rest))
    front = F.exp(a * F.log(x) + b * F.log(rest) - ln_beta(a, b))
    near = x < (a + 1) / (a + b + 2)
    value = F.when(near, front * _fraction(a, b, x) / a).otherwise(1 - front * _fraction(b, a, rest) / b)
    return F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).otherwise(value)


def p_of_t(t: Column, df: Column) -> Column:
    """Two-sided tail of Student's t."""
    whole = df + t * t
    return incomplete_beta(df / 2, F.lit(0.5), df / whole, t * t / whole)


def p_of_f(f: Column, df_between: Column, df_within: Column) -> Column:
    """Upper tail of F."""
    whole = df_within + df_between * f
    return incomplete_beta(df_within / 2, df_between / 2, df_within / whole, df_between * f / whole)
