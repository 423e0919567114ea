"""Layer runs in dependency order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tallyhouse.operators import scratch
from tallyhouse.operators.publish import rebuild
from tallyhouse.plans import dimensions, facts, marketing, metrics, staging
from tallyhouse.plans.bronze import log_run, run_bronze
from tallyhouse.plans.quality import gate_checks, run_quality, table_checks
from tallyhouse.plans.silver import run_silver
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.spine import DEFAULT_END, DEFAULT_START
from tallyhouse.sources.tables import Lake


def staged(lake: Lake) -> dict[str, DataFrame]:
    """Staging views over the current silver tables."""
    return {
        "customers": staging.stg_customers(lake.read("silver", "customers")),
        "products": staging.stg_products(lake.read("silver", "products")),
        "orders": staging.stg_orders(lake.read("silver", "orders")),
        "order_items": staging.stg_order_items(lake.read("silver", "order_items")),
    }


def create_views(lake: Lake) -> None:
    """Staging and intermediate models as temporary views, gold tables under their names."""
    s = staged(lake)
    for name, df in s.items():
        df.createOrReplaceTempView(f"stg_{name}")
    metrics.int_customer_orders(s["orders"], s["order_items"]).createOrReplaceTempView("int_customer_orders")
    metrics.int_product_metrics(s["order_items"], s["orders"], s["products"]).createOrReplaceTempView("int_product_metrics")
    for table in GOLD_TABLES:
        if lake.has("gold", table):
            lake.read("gold", table).createOrReplaceTempView(table)


def sized(lake: Lake):
    """Shuffles inside the block fit the stored lines."""
    return scratch.partitions_for(lake.spark, lake.read("silver", "order_items").count())


GOLD_TABLES = ("dim_date", "dim_customers", "dim_products", "fact_orders", "daily_sales", "customer_ltv")


def run_gold(lake: Lake, start=DEFAULT_START, end=DEFAULT_END, as_of=None, recency: str = "documented") -> None:
    """Rebuild the six gold tables. Each later table reads the published earlier ones."""
    with scratch.scope(lake.spark), sized(lake):
        _build_gold(lake, start, end, as_of, recency)


def _build_gold(lake: Lake, start, end, as_of, recency: str) -> None:
    s = staged(lake)
    # Customers, products and the fact all bring the lines together by order: they are moved once, here.
    by_order = scratch.new_path(lake.spark, "order-items")
    s["order_items"] = scratch.store_by(s["order_items"], "order_id", "order-items", by_order)
    dates = rebuild(lake, "gold", "dim_date", dimensions.dim_date(lake.spark, start, end, as_of).coalesce(1))
    customers = rebuild(lake, "gold", "dim_customers", dimensions.dim_customers(
        s["customers"], metrics.int_customer_orders(s["orders"], s["order_items"]), recency))
    products = rebuild(lake, "gold", "dim_products", dimensions.dim_products(
        s["products"], metrics.int_product_metrics(s["order_items"], s["orders"], s["products"])))
    # The joins and the way into months are two steps, so that the disk holds the files of one of them at a time.
    lines, joined = scratch.store(facts.narrow_lines(s["order_items"], s["orders"], products, customers), "fact-lines")
    scratch.discard(lake.spark, by_order)
    fact = rebuild(lake, "gold", "fact_orders", lines, partition_by="order_month", sort_by="order_id", widen=lambda rows: facts.widened(rows, dates))
    scratch.discard(lake.spark, joined)
    rebuild(lake, "gold", "daily_sales", marketing.daily_sales(fact, dates))
    rebuild(lake, "gold", "customer_ltv", marketing.customer_ltv(customers, as_of))


def run_all(lake: Lake, folder: str, start=DEFAULT_START, end=DEFAULT_END, as_of=None, mode: str = "skip_existing",
            entities=tuple(ENTITIES)) -> None:
    """Files to bronze to silver, the quality gate, gold, then the table checks."""
    started = dt.datetime.now()
    run_bronze(lake, folder, entities, mode)

    def step(name: str, work):
        """Run one step and log it, whatever its outcome."""
        begun = dt.datetime.now()
        try:
            result, rows = work()
        except Exception as exc:
            log_run(lake, name, "failed", 0, begun, dt.datetime.now(), str(exc))
            raise
        log_run(lake, name, "success", rows, begun, dt.datetime.now())
        return result

    def clean():
        written = run_silver(lake)
        return written, written.agg({"written": "sum"}).first()[0]

    def check(checks):
        def work():
            with sized(lake):
                return run_quality(lake, staged(lake), checks), 0
        return work

    written = step("silver", clean)
    step("quality_gate", check(gate_checks(as_of)))
    step("gold", lambda: (run_gold(lake, start, end, as_of), 0))
    step("table_checks", check(table_checks()))
    log_run(lake, "full_run", "success", written.agg({"written": "sum"}).first()[0], started, dt.datetime.now())
