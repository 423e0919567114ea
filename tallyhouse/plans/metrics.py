"""Order history per customer and sales per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import mean, mean_of, percent_of, ratio


def int_customer_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per customer with at least one order.

    Revenue comes from the order header. The line counts are grouped by order before the join, so the
    join is one-to-one and Spark drops it when only header measures are read.
    """
    lines = items.groupBy("order_id").agg(F.count("item_id").alias("item_count"))
    headers = orders.select("order_id", "customer_id", "order_date", "is_completed", "is_cancelled",
                            "is_returned", "total_amount")
    per_order = headers.join(lines, "order_id", "left").withColumn(
        "item_count", F.coalesce("item_count", F.lit(0)))

    done = F.col("is_completed")
    amount = F.when(done, F.col("total_amount"))
    day = F.when(done, F.col("order_date"))
    n_done = F.count_if(done)
    return per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        n_done.alias("completed_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.count_if("is_returned").alias("returned_orders"),
        F.sum(amount).cast("decimal(18,2)").alias("total_revenue"),
        mean_of(amount, 6).alias("avg_order_value"),
        F.max(amount).alias("max_order_value"),
        F.max(day).alias("last_order_date"),
        F.min(day).alias("first_order_date"),
        F.datediff(F.max(day), F.min(day)).alias("customer_age_days"),
        mean(F.sum(F.when(done, F.col("item_count"))).cast("decimal(20,0)"), n_done).alias("avg_items_per_order"),
        percent_of(F.count_if("is_cancelled"), F.count("order_id")).alias("cancellation_rate_pct"),
    )


def int_product_metrics(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product with at least one sold line.

    Order counts and dates cover every status; units, revenue and price cover completed orders. Lines
    are grouped by (product, order) first, which makes the distinct order counts plain counts.
    """
    headers = orders.select("order_id", "order_date", "is_completed")
    lines = items.select("product_id", "order_id", "quantity", "line_total", "effective_unit_price").join(headers, "order_id")
    done = F.col("is_completed")

    def if_done(name: str):
        return F.when(done, F.col(name))

    per_order = lines.groupBy("order_id", "product_id", "order_date", "is_completed").agg(
        F.sum(if_done("quantity")).alias("units"),
        F.sum(if_done("line_total")).alias("revenue"),
        F.sum(if_done("effective_unit_price")).alias("prices"),
        F.count(if_done("effective_unit_price")).alias("priced_lines"),
    )
    sales = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(done).alias("completed_orders"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast("decimal(18,2)").alias("gross_revenue"),
        mean(F.sum("prices"), F.sum("priced_lines"), 6).alias("avg_selling_price"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
    )
    about = products.select("product_id", "product_name", "category", "subcategory", "brand", "cost_price",
                            "selling_price", "margin_pct", "margin_tier", "stock_quantity", "stock_status")
    units = F.col("units_sold").cast("decimal(20,0)")
    return sales.join(about, "product_id").withColumns({
        "gross_profit": F.round(F.col("gross_revenue") - units * F.col("cost_price"), 2).cast("decimal(18,2)"),
        "revenue_per_unit": ratio(F.col("gross_revenue"), units).cast("decimal(18,2)"),
        "sell_through_rate_pct": ratio(units, units + F.col("stock_quantity"), 2, times=100).cast("decimal(18,2)"),
    })
