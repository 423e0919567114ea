"""Sales summaries that reports read instead of the fact, kept by month.

Sums and order counts add up over every attribute of an order, since an order has one day, customer, status and shipping
method; they are stored per day and these attributes, and apart from that per category. Customer counts don't add up over
time: the customers of a month or a week are stored as bitmaps over customer numbers, and a report joins bitmaps with OR.
A row holds the bits of one bucket of 32,768 customers.

Customers are numbered by segment and state, so that a state's customers share buckets and splitting a month's bitmap by
state hardly adds rows. A number once given stays; new customers get the next ones.

Every table is partitioned by ``order_month``: a refresh replaces the partitions of its months and no others.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import scratch
from tallyhouse.operators.distinct import sales_rollup
from tallyhouse.operators.ranking import global_row_number
from tallyhouse.sources import files
from tallyhouse.sources.tables import SUMMARIES, Lake

BUCKET = 32_768

_MONTH = ("order_month", "month_name", "year")
_OF_CUSTOMER = ("customer_segment", "customer_state")
_OF_ORDER = (*_MONTH, "order_date", "order_week", *_OF_CUSTOMER, "order_status", "is_completed", "shipping_method", "shipped")
DAYS, CATEGORIES, DAY_CUSTOMERS, WEEK_SETS, MONTH_SETS = (
    "sales_days", "sales_categories", "day_customers", "week_customer_sets", "month_customer_sets")
NUMBERS = "customer_numbers"
# Columns of the fact that summaries are made of.
OF_FACT = (*(c for c in _OF_ORDER if c != "shipped"), "order_id", "customer_id", "category", "gross_revenue", "gross_profit", "quantity", "days_to_ship")
SCHEMA = "_schema.json"


def measures() -> dict[str, Column]:
    """What is summed over order lines, by the name reports use."""
    unit_price = F.col("gross_revenue") / F.nullif(F.col("quantity"), F.lit(0)).cast("decimal(10,0)")
    return {
        "revenue": F.col("gross_revenue"), "profit": F.col("gross_profit"), "units": F.col("quantity"),
        "prices": unit_price.cast("decimal(22,10)"), "priced": F.when(unit_price.isNotNull(), 1).otherwise(0),
        "days": F.col("days_to_ship").cast("long"), "lines": F.lit(1).cast("long"),
    }


def number_customers(lake: Lake, lines: DataFrame) -> DataFrame:
    """customer_id and number of all customers so far; those of ``lines`` that have none get the next ones."""
    seen = lines.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(*[F.min(c).alias(c) for c in _OF_CUSTOMER])
    start = 0
    if lake.has(SUMMARIES, NUMBERS):
        known = lake.read(SUMMARIES, NUMBERS)
        start = known.agg(F.max("number")).first()[0] or 0
        seen = seen.join(known.select("customer_id"), "customer_id", "left_anti")
    with scratch.scope(lake.spark):
        new = global_row_number(seen, [F.col(c) for c in (*_OF_CUSTOMER, "customer_id")], "number")
        new.select("customer_id", (F.col("number") + start).alias("number")).write.mode("append").parquet(lake.path(SUMMARIES, NUMBERS))
    return lake.read(SUMMARIES, NUMBERS)


def _sets(customers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the customers (column place, from 0) of each key, by bucket."""
    bucket = F.expr(f"place DIV {BUCKET}").alias("bucket")
    return customers.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.col("place") % BUCKET).alias("bits"))


def _replace(lake: Lake, table: str, rows: DataFrame, months: Sequence[dt.date] | None) -> None:
    """Put the rows' months in place of the stored ones; months without rows go."""
    path = lake.path(SUMMARIES, table)
    if months is None:
        files.delete(lake.spark, path)
    writer = rows.hint("rebalance", "order_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("order_month").parquet(path)
    files.write_text(lake.spark, f"{path}/{SCHEMA}", rows.schema.json())
    if months:
        left = {r[0] for r in rows.select("order_month").distinct().collect()}
        for month in set(months) - left:
            files.delete(lake.spark, f"{path}/order_month={month}")


def _read(lake: Lake, table: str) -> DataFrame:
    """A summary with its stored schema: a table without any month has no file that would tell it."""
    path = lake.path(SUMMARIES, table)
    schema = T.StructType.fromJson(json.loads(files.read_text(lake.spark, f"{path}/{SCHEMA}")))
    return lake.spark.read.schema(schema).parquet(path)


def refresh(lake: Lake, fact: DataFrame, months: Iterable[dt.date] | None = None) -> None:
    """Summaries of the given months of the fact (first days of months), or of all of it."""
    months = None if months is None else sorted(set(months))
    if months is not None:
        fact = fact.filter(F.col("order_month").isin(*months)) if months else fact.limit(0)
    with scratch.partitions_for(lake.spark, fact.count()):
        _refresh(lake, fact, months)


def _refresh(lake: Lake, fact: DataFrame, months: list[dt.date] | None) -> None:
    numbers = number_customers(lake, fact.filter("is_completed"))
    fact = fact.withColumn("shipped", F.col("days_to_ship").isNotNull())
    done, names = fact.filter("is_completed"), list(measures())
    with scratch.scope(lake.spark):
        days, _ = scratch.store(sales_rollup(fact, _OF_ORDER, measures(), customers=None), "summary-days")
        _replace(lake, DAYS, days, months)
        sums = {n: c for n, c in measures().items() if n in names[:3]}
        kinds, _ = scratch.store(sales_rollup(done, ["order_month", "customer_segment", "category"], sums, customers=None), "summary-categories")
        _replace(lake, CATEGORIES, kinds, months)
        by_day = done.filter(F.col("customer_id").isNotNull()).select(*_MONTH, "order_week", "order_date", *_OF_CUSTOMER, "customer_id").distinct()
        by_day, _ = scratch.store(by_day, "summary-customers")
        counted = by_day.groupBy(*_MONTH, "order_date", "customer_segment").agg(F.count("customer_id").alias("customers"))
        _replace(lake, DAY_CUSTOMERS, counted, months)
        placed = by_day.drop("order_date").distinct().join(numbers, "customer_id").withColumn("place", F.col("number") - 1)
        placed, _ = scratch.store(placed, "summary-places")
        _replace(lake, WEEK_SETS, _sets(placed, (*_MONTH, "order_week", "customer_segment")), months)
        _replace(lake, MONTH_SETS, _sets(placed, (*_MONTH, *_OF_CUSTOMER)), months)


@dataclass(frozen=True)
class Summaries:
    """The stored summaries, in place of the fact in the reports on overview and sales."""

    lake: Lake

    def rollup(self, keys: dict[str, Column], sums: Sequence[str], where: Column, customers_where: Column,
               orders: str = "orders", customers: str | None = "customers") -> DataFrame:
        """Per key: the sums, the number of orders, and of distinct customers of completed orders if asked for.

        keys: name to expression over columns of the day summary (or ``category``).
        """
        table = CATEGORIES if "category" in keys else DAYS
        rows = _read(self.lake, table).filter(where)
        totals = rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
            F.sum("orders").alias(orders), *[F.sum(n).alias(n) for n in sums])
        if customers is None:
            return totals
        counts = self._customers(list(keys), customers_where, customers)
        # Both sides in one grouping: keys may be NULL, which no join would match.
        both = totals.withColumn(customers, F.lit(None).cast("long")).unionByName(counts, allowMissingColumns=True)
        return both.groupBy(*keys).agg(
            F.sum(orders).alias(orders), F.coalesce(F.sum(customers), F.lit(0)).alias(customers), *[F.sum(n).alias(n) for n in sums])

    def _customers(self, keys: list[str], where: Column, name: str) -> DataFrame:
        if "order_date" in keys:
            return _read(self.lake, DAY_CUSTOMERS).filter(where).groupBy(*keys).agg(F.sum("customers").alias(name))
        sets = _read(self.lake, WEEK_SETS if "order_week" in keys else MONTH_SETS).filter(where)
        union = sets.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        return union.groupBy(*keys).agg(F.sum("n").alias(name))


def all_of(conditions: Iterable[Column | None]) -> Column:
    """All given conditions; true when there is none."""
    given = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, given) if given else F.lit(True)
