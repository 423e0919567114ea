"""Calendar expressions over DATE columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(d: Column) -> Column:
    """Day of the week, Sunday = 0."""
    return F.dayofweek(d) - F.lit(1)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "week")


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def is_weekend(d: Column) -> Column:
    return day_number(d).isin(0, 6)


def months_between_starts(later: Column, earlier: Column, offset: str = "total") -> Column:
    """Months from ``earlier`` to ``later``.

    ``total`` counts all months; ``as_written`` gives the month field of the age (it wraps every
    twelve months and keeps the sign).
    """
    total = (F.year(later) - F.year(earlier)) * F.lit(12) + F.month(later) - F.month(earlier)
    if offset == "total":
        return total.cast("int")
    if offset == "as_written":
        return (total % F.lit(12)).cast("int")
    raise ValueError(f"offset must be 'total' or 'as_written', not {offset!r}")


def as_date(value: dt.date | str | None) -> Column:
    """The day a time-dependent table is built for; today when none is given."""
    return F.current_date() if value is None else F.lit(value).cast("date")
