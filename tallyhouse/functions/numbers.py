"""Exact ratios, rounding and bands.

Money stays decimal from the source to the report: sums of doubles depend on the order of addition,
which a shuffle does not fix.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import MONEY


def money(col: Column) -> Column:
    return F.round(col, 2).cast(MONEY)


def ratio(num: Column, den: Column, digits: int = 2, times: int = 1) -> Column:
    """``times * num / den`` over decimals, rounded half away from zero; NULL when ``den`` is 0."""
    top = num * F.lit(times) if times != 1 else num
    return F.round(top / F.nullif(den, F.lit(0).cast("decimal(1,0)")), digits)


def counted(n: Column) -> Column:
    """A count as a decimal, so that a division by or of it stays exact."""
    return n.cast("decimal(20,0)")


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    return ratio(total, counted(n), digits).cast(f"decimal(18,{digits})")


def mean_of(col: Column, digits: int = 2) -> Column:
    """Aggregate: exact mean of a decimal column over its non-NULL values."""
    return mean(F.sum(col), F.count(col), digits)


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of two counts."""
    return ratio(counted(part), counted(whole), digits, times=100).cast(f"decimal(18,{digits})")


def bands(col: Column, steps: Iterable[tuple[str, object]], otherwise: str, op: str = "ge") -> Column:
    """Label of the first step whose limit the value meets; NULL falls through to ``otherwise``."""
    tests = {"ge": lambda x, y: x >= y, "gt": lambda x, y: x > y, "lt": lambda x, y: x < y, "eq": lambda x, y: x == y}
    out = None
    for step in steps:
        label, limit = step[0], step[1]
        test = tests[step[2] if len(step) > 2 else op](col, F.lit(limit))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)
