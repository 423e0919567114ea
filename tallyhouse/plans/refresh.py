"""Gold kept current: what changed in silver decides which months of the fact are written again.

A silver row says when it was written. From the rows written since the last gold run, and from what the new dimensions
say differently from the published ones, follow the months of all order lines that can look different: those where they lie
now and those where they come to lie. Only these months of the fact, their days in the daily sales and their summaries are
written; the lines of a touched month come from the stored fact, except those that changed. Dimensions have a row a
customer or product and scores that rank all of them; they are computed whole.

The marks move on, and the dimensions are published, after the fact: a run that failed half-way is repeated with the
same months.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.operators import scratch
from tallyhouse.operators.publish import append, rebuild
from tallyhouse.plans import dimensions, facts, marketing, metrics, runs, summaries
from tallyhouse.sources import files
from tallyhouse.sources.spine import DEFAULT_END, DEFAULT_START
from tallyhouse.sources.tables import SUMMARIES, Lake, current_version

MARKS = "gold_marks"
_SILVER = ("customers", "products", "orders", "order_items")
_KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "item_id"}


def newest_stamps(lake: Lake) -> DataFrame:
    """(table, mark): the latest stamp of every silver table; before all stamps where a table has none."""
    stamps = [lake.read("silver", t).agg(F.lit(t).alias("table"), F.max("_updated_at").alias("mark")) for t in _SILVER]
    return reduce(DataFrame.unionByName, stamps).select("table", F.coalesce("mark", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp")).alias("mark"))


def differing(new: DataFrame, old: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Keys of ``new`` that ``old`` lacks or has with another value in a column."""
    before = old.select(F.col(key).alias("_key"), F.lit(True).alias("_known"), *[F.col(c).alias(f"_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    joined = new.join(before, F.col(key) == F.col("_key"), "left")
    return joined.filter(F.col("_known").isNull() | ~same).select(key)


def _of(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is among those given; the key's column has the same name on both sides."""
    return rows.join(keys, keys.columns[0], "left_semi")


def run_all_and_mark(lake: Lake, start, end, as_of, recency: str) -> None:
    """A full gold run that later runs can start from."""
    marks = newest_stamps(lake).collect()
    runs.run_gold(lake, start, end, as_of, recency)
    summaries.refresh(lake, lake.read("gold", "fact_orders"))
    append(lake, MARKS, lake.spark.createDataFrame(marks, "table string, mark timestamp").coalesce(1))


def refresh_gold(lake: Lake, start=DEFAULT_START, end=DEFAULT_END, as_of=None, recency: str = "documented") -> list[dt.date] | None:
    """Bring the gold tables and summaries up to date; returns the months written, None for a full run.

    The first run, and one after gold was built without marks, is full.
    """
    if not lake.has("bronze", MARKS) or not all(lake.has("gold", t) for t in runs.GOLD_TABLES):
        run_all_and_mark(lake, start, end, as_of, recency)
        return None
    with scratch.scope(lake.spark), runs.sized(lake):
        return _refresh(lake, start, end, as_of, recency)


def _refresh(lake: Lake, start, end, as_of, recency: str) -> list[dt.date]:
    spark = lake.spark
    since = {r["table"]: r["mark"] for r in lake.read("bronze", MARKS).groupBy("table").agg(F.max("mark").alias("mark")).collect()}
    marks = newest_stamps(lake).collect()
    changed = {
        t: lake.read("silver", t).filter(F.col("_updated_at").isNotNull() & (F.col("_updated_at") > F.lit(since[t]))).select(_KEYS[t]) for t in _SILVER
    }
    s = runs.staged(lake)
    dates, _ = scratch.store(dimensions.dim_date(spark, start, end, as_of).coalesce(1), "dates")
    customers, _ = scratch.store(dimensions.dim_customers(
        s["customers"], metrics.int_customer_orders(s["orders"], s["order_items"]), recency), "customers")
    products, _ = scratch.store(dimensions.dim_products(
        s["products"], metrics.int_product_metrics(s["order_items"], s["orders"], s["products"])), "products")

    old = {t: lake.read("gold", t) for t in ("dim_date", "dim_customers", "dim_products", "fact_orders", "daily_sales")}
    other_customers, _ = scratch.store(differing(customers, old["dim_customers"], "customer_id", facts.CUSTOMER_COLUMNS), "other-customers")
    other_products, _ = scratch.store(differing(products, old["dim_products"], "product_id", facts.PRODUCT_COLUMNS), "other-products")
    other_days = differing(dates, old["dim_date"], "date", facts.DAY_COLUMNS).select(F.col("date").alias("order_date"))
    new_products = products.select("product_id").join(old["dim_products"], "product_id", "left_anti")

    # Lines that the stored fact cannot give: changed ones, all lines of changed orders, and of products it did not know.
    items = s["order_items"]
    fresh = _of(items, changed["order_items"]).unionByName(_of(items, changed["orders"])).unionByName(_of(items, new_products))
    fresh, _ = scratch.store(fresh.dropDuplicates(["item_id"]), "fresh-lines")

    fact, orders = old["fact_orders"], s["orders"]
    touched = [_of(fact, k) for k in (changed["order_items"], changed["orders"], other_customers, other_products, other_days)]
    touched += [_of(orders, changed["orders"]), _of(orders, fresh.select("order_id"))]
    months = reduce(DataFrame.unionByName, [t.select("order_month") for t in touched]).distinct()
    months = sorted(r[0] for r in months.collect())

    if months:
        here = F.col("order_month").isin(*months)
        kept = fact.filter(here).join(fresh.select("item_id"), "item_id", "left_anti").join(changed["orders"], "order_id", "left_anti")
        columns = [c for c in facts.ITEM_COLUMNS if c != "line_total"]
        lines = kept.select(*columns, F.col("gross_revenue").alias("line_total")).unionByName(fresh.select(*facts.ITEM_COLUMNS))
        new, _ = scratch.store(facts.fact_orders(lines, orders.filter(here), products, customers, dates), "fact-months")
        replace_months(lake, new, months)
        fact = lake.read("gold", "fact_orders")
    day = F.col("order_date")
    touched_days = fact.filter(F.col("order_month").isin(*months)).select("order_date") if months else fact.limit(0).select("order_date")
    touched_days = touched_days.unionByName(old["daily_sales"].filter(D.month_start(day).isin(*months)).select("order_date") if months else touched_days)
    daily, _ = scratch.store(marketing.refresh_days(old["daily_sales"], fact, dates, touched_days), "daily")
    if lake.has(SUMMARIES, summaries.DAYS):
        summaries.refresh(lake, fact, months)
    rebuild(lake, "gold", "daily_sales", daily)
    rebuild(lake, "gold", "dim_date", dates.coalesce(1))
    rebuild(lake, "gold", "dim_products", products)
    rebuild(lake, "gold", "customer_ltv", marketing.customer_ltv(rebuild(lake, "gold", "dim_customers", customers), as_of))
    append(lake, MARKS, spark.createDataFrame(marks, "table string, mark timestamp").coalesce(1))
    return months


def replace_months(lake: Lake, rows: DataFrame, months: list[dt.date]) -> None:
    """Put the rows' months in place of those of the published fact; months without rows go.

    Spark stages the files and swaps one partition after the other when the job commits.
    """
    path = current_version(lake.spark, lake.path("gold", "fact_orders"))
    arranged = rows.hint("rebalance", "order_month").sortWithinPartitions("order_month", "order_id")
    arranged.write.mode("overwrite").option(*scratch.PACKED).option("partitionOverwriteMode", "dynamic").partitionBy("order_month").parquet(path)
    left = {r[0] for r in rows.select("order_month").distinct().collect()}
    for month in set(months) - left:
        files.delete(lake.spark, f"{path}/order_month={month}")
