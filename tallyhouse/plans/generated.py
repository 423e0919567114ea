"""Columns the silver tables derive from their own row."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import ratio
from tallyhouse.schemas import AMOUNT, PERCENT


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL, hence not ``concat_ws``."""
    return F.concat(first, F.lit(" "), last)


def margin_pct(price: Column, cost: Column) -> Column:
    return F.when(price > 0, ratio(price - cost, price, 2, times=100)).otherwise(F.lit(0)).cast(PERCENT)


def days_to_ship(ordered: Column, shipped: Column) -> Column:
    return F.datediff(shipped, ordered)


def line_total(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """NULL when the product does not fit an amount."""
    kept = (F.lit(100) - discount_pct) / F.lit(100).cast("decimal(3,0)")
    any_line = F.round(quantity * unit_price * kept, 2).try_cast(AMOUNT)
    # Lines of usual size in whole cents, where no step leaves 64 bits; decimals cost many times as much.
    price, discount = unit_price.cast("double"), discount_pct.cast("double")
    usual = quantity.between(0, 100_000) & price.between(-1e6, 1e6) & discount.between(0.0, 100.0)
    millionths = quantity.cast("long") * _cents(price) * (F.lit(10_000).cast("long") - _cents(discount))
    half = F.when(price < 0, F.lit(-5_000).cast("long")).otherwise(F.lit(5_000).cast("long"))
    cents = F.call_function("div", millionths + half, F.lit(10_000).cast("long"))
    return F.when(usual, (cents.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).try_cast(AMOUNT)).otherwise(any_line)


def _cents(amount: Column) -> Column:
    """Whole cents of a double that holds an amount with two decimals, below ten million."""
    return F.rint(amount * 100).cast("long")
