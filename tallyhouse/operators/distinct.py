"""Sales sums with exact order and customer counts, without expanding the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sales_rollup(
    lines: DataFrame,
    keys: Sequence[str],
    sums: dict[str, Column],
    orders: str = "orders",
    customers: str | None = "customers",
) -> DataFrame:
    """Per key: the sums plus the numbers of distinct orders and customers.

    Two ``count(DISTINCT)`` in one grouping make Spark copy every line three times. An order has one
    customer, so grouping by order, then by customer, then by key gives the same counts from plain
    aggregates, each with map-side pre-aggregation; no level puts one key's rows into one task. Lines
    that already sit by order (after the order join) need no shuffle for the first level; lines of the
    stored fact, which lies by month, move one row per order.
    """
    keys = list(keys)
    per_order = lines.groupBy(*keys, "order_id", "customer_id").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()])
    totals = [F.sum(n).alias(n) for n in sums]
    if customers is None:
        return per_order.groupBy(*keys).agg(F.count("order_id").alias(orders), *totals)
    per_customer = per_order.groupBy(*keys, "customer_id").agg(F.count("order_id").alias(orders), *totals)
    return per_customer.groupBy(*keys).agg(
        F.sum(orders).alias(orders), F.count("customer_id").alias(customers), *totals)
