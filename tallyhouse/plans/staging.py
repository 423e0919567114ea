"""Staging views over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import bands, ratio
from tallyhouse.functions.text import blank_to_null

# Margin and stock bands.
MARGIN_TIERS = (("High Margin", 60), ("Medium Margin", 40), ("Low Margin", 20))
MARGIN_REST = "Negative Margin"
STOCK_STATES = (("Out of Stock", 0, "eq"), ("Low Stock", 10, "lt"), ("Normal Stock", 50, "lt"))
STOCK_REST = "Well Stocked"


def stg_customers(silver: DataFrame) -> DataFrame:
    return silver.withColumnRenamed("_updated_at", "updated_at")


def stg_products(silver: DataFrame) -> DataFrame:
    return silver.select(
        "product_id", "product_name", "category",
        F.coalesce("subcategory", F.lit("Other")).alias("subcategory"),
        "brand", "cost_price", "selling_price", "margin_pct", "stock_quantity", "sku",
        bands(F.col("margin_pct"), MARGIN_TIERS, MARGIN_REST).alias("margin_tier"),
        bands(F.col("stock_quantity"), STOCK_STATES, STOCK_REST).alias("stock_status"),
        F.col("_updated_at").alias("updated_at"),
    )


def calendar(day: Column) -> dict[str, Column]:
    """What the day of an order tells by itself, beside its month."""
    return {"order_week": D.week_start(day), "order_year": F.year(day), "order_month_num": F.month(day), "order_day_of_week": D.day_number(day)}


def stg_orders(silver: DataFrame) -> DataFrame:
    day, status = F.col("order_date"), F.col("order_status")
    flags = {f"is_{s}": F.coalesce(status == s, F.lit(False)) for s in ("completed", "cancelled", "returned")}
    return silver.select(
        "order_id", "customer_id", "order_date", "ship_date", "days_to_ship", "shipping_method",
        "order_status", "total_amount",
        blank_to_null(F.col("discount_code")).alias("discount_code"),
        *[flag.alias(name) for name, flag in flags.items()],
        D.month_start(day).alias("order_month"),
        *[c.alias(name) for name, c in calendar(day).items()],
        F.col("_updated_at").alias("updated_at"),
    )


def stg_order_items(silver: DataFrame) -> DataFrame:
    return silver.select(
        "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total",
        ratio(F.col("line_total"), F.col("quantity").cast("decimal(10,0)")).cast("decimal(12,2)").alias("effective_unit_price"),
        F.col("_updated_at").alias("updated_at"),
    )
