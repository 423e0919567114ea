"""Order-line fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans import staging

DAY_COLUMNS = ("date_id", "year", "quarter", "quarter_label", "month", "month_name", "week_of_year", "is_weekend")
CUSTOMER_COLUMNS = ("customer_segment", "state", "rfm_segment", "customer_tier")
PRODUCT_COLUMNS = ("category", "subcategory", "brand", "cost_price", "margin_pct")
ITEM_COLUMNS = ("item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total")


# What the day of an order tells; it is joined last where lines are moved, since a row a day is quicker to look up than to carry.
CALENDAR = ("order_week", "order_year", "order_month_num", "order_day_of_week")


def fact_orders(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per order line, every status.

    Customer and day attributes belong to the order, so they join to the headers; only the header join
    and the product join touch the lines. Spark picks broadcast or shuffle for each from the measured
    sizes. ``customers`` may be the staging view, when the segment and tier columns are not needed.
    """
    return _finished(_joined(items, with_days(orders, dates), products, customers))


def narrow_lines(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The lines of ``fact_orders`` without what ``widened`` adds: the joins are done, and the rows small enough to be moved once more."""
    return _joined(items, orders.drop(*CALENDAR), products, customers)


def widened(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """``narrow_lines`` as rows of the fact; they stay where they are."""
    days = dates.select(F.col("date").alias("order_date"), *DAY_COLUMNS)
    # A row a day, whatever the number of lines.
    return _finished(lines.withColumns(staging.calendar(F.col("order_date"))).join(F.broadcast(days), "order_date", "left"))


def with_days(orders: DataFrame, dates: DataFrame) -> DataFrame:
    return orders.join(dates.select(F.col("date").alias("order_date"), *DAY_COLUMNS), "order_date", "left")


def _joined(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    of_customer = [c for c in CUSTOMER_COLUMNS if c in customers.columns]
    headers = (
        orders.drop("ship_date", "total_amount", "updated_at")
        .join(customers.select("customer_id", *of_customer), "customer_id", "left")
        .withColumnRenamed("state", "customer_state")
    )
    about = products.select("product_id", "category", "subcategory", "brand",
                            F.col("cost_price").alias("product_cost"), F.col("margin_pct").alias("product_margin_pct"))
    lines = items.select("item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct",
                         F.col("line_total").alias("gross_revenue"))
    return lines.join(headers, "order_id").join(about, "product_id")


def _finished(lines: DataFrame) -> DataFrame:
    """The fact's columns in their order."""
    cost = F.col("quantity") * F.col("product_cost")
    fact = lines.withColumns({
        "cogs": F.round(cost, 2).cast("decimal(14,2)"),
        "gross_profit": F.round(F.col("gross_revenue") - cost, 2).cast("decimal(14,2)"),
    })
    attributes = [c for c in ("customer_segment", "customer_state", "rfm_segment", "customer_tier") if c in lines.columns]
    return fact.select(
        "item_id", "order_id", "product_id", "customer_id", "date_id",
        "order_date", "order_status", "is_completed", "is_cancelled", "is_returned", "shipping_method",
        "discount_code", "days_to_ship", "order_month", "order_week", "order_year", "order_month_num",
        "order_day_of_week",
        "category", "subcategory", "brand", "product_cost", "product_margin_pct",
        *attributes,
        "year", "quarter", "quarter_label", "month", "month_name", "week_of_year", "is_weekend",
        "quantity", "unit_price", "discount_pct", "gross_revenue", "cogs", "gross_profit",
    )
