"""Tail probabilities against published values and exact forms."""

import math

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import stats
from tallyhouse.plans import analysis


def p(spark, column):
    return spark.range(1).select(column.alias("p")).first().p


def t_tail(df, t, steps=400_000):
    """Two-sided tail by summing the density (Simpson), normalised with exact gammas."""
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    h = t / steps
    inside = sum((1 if i in (0, steps) else 4 if i % 2 else 2) * (1 + (i * h) ** 2 / df) ** (-(df + 1) / 2) for i in range(steps + 1)) * h / 3
    return 1 - 2 * scale * inside


def test_exact_forms(spark):
    for t in (0.1, 1.0, 2.5, 40.0):  # one degree of freedom: the Cauchy distribution; two: a closed form
        assert p(spark, stats.p_of_t(F.lit(t), F.lit(1.0))) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-13)
        assert p(spark, stats.p_of_t(F.lit(t), F.lit(2.0))) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-13)
    for f in (0.2, 1.0, 9.0):  # two degrees between: a power
        assert p(spark, stats.p_of_f(F.lit(f), F.lit(2), F.lit(30))) == pytest.approx((1 + 2 * f / 30) ** -15, rel=1e-12)


def test_large_degrees_of_freedom(spark):
    """A million degrees: the normal tail with its first corrections in 1/df."""
    n = 1e6
    for t in (0.5, 1.7, 2.0, 4.0):
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        want = math.erfc(t / math.sqrt(2)) + 2 * density * (t**3 + t) / (4 * n)
        assert p(spark, stats.p_of_t(F.lit(t), F.lit(n))) == pytest.approx(want, abs=1e-9)
    assert p(spark, stats.p_of_f(F.lit(4.0), F.lit(1), F.lit(1_000_000))) == pytest.approx(p(spark, stats.p_of_t(F.lit(2.0), F.lit(n))), abs=1e-11)


def test_fractional_degrees(spark):
    for df, t in ((7.3, 2.1), (151.62, 0.8)):
        assert p(spark, stats.p_of_t(F.lit(t), F.lit(df))) == pytest.approx(t_tail(df, t, 20_000), abs=1e-9)


def test_tests_of_groups(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 1.0), ("b", 2.0), ("b", 4.0), ("c", None)], "g string, v double")
    same = analysis.welch_test(rows, "g", "a", "b", "v").first()
    assert same.t == 0 and same.p_value == 1
    assert analysis.welch_test(rows, "g", "a", "c", "v").first().p_value is None
    assert analysis.anova_test(rows, "g", "v").first().p_value == pytest.approx(1)
