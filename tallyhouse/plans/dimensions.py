"""Date, customer and product dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import bands, ratio
from tallyhouse.operators import scratch
from tallyhouse.operators.ranking import Scale, ntile_columns
from tallyhouse.sources.spine import DEFAULT_END, DEFAULT_START, date_spine

# Value bands of customers and products.
CUSTOMER_TIERS = (("Platinum", 2000), ("Gold", 1000), ("Silver", 300), ("Bronze", 0, "gt"))
CUSTOMER_REST = "Inactive"
PRODUCT_TIERS = (("Top Performer", 10000), ("Strong Performer", 3000), ("Average Performer", 500), ("Low Performer", 0, "gt"))
PRODUCT_REST = "No Sales"
# Fixed value: segment of customers without any order.
NO_ORDERS = "No Orders"


def dim_date(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END, as_of=None, padded_names: bool = False) -> DataFrame:
    """One row per day. ``padded_names`` blank-pads month and day names to nine characters."""
    day, today = F.col("date"), D.as_date(as_of)

    def name(fmt: str) -> Column:
        text = F.date_format(day, fmt)
        return F.rpad(text, 9, " ") if padded_names else text

    return date_spine(spark, start, end).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        D.quarter_label(day).alias("quarter_label"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_short"),
        name("MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        D.day_number(day).alias("day_of_week"),
        name("EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        D.is_weekend(day).alias("is_weekend"),
        D.month_start(day).alias("first_day_of_month"),
        F.last_day(day).alias("last_day_of_month"),
        F.trunc(day, "quarter").alias("first_day_of_quarter"),
        F.trunc(day, "year").alias("first_day_of_year"),
        (day >= F.trunc(today, "month")).alias("is_current_month"),
        (day >= F.trunc(today, "year")).alias("is_current_year"),
    )


def rfm_scales(recency: str = "documented") -> dict[str, Scale]:
    """Recency, frequency and monetary rankings.

    ``documented``: 5 is the latest, most frequent, highest revenue, and customers without a completed
    order rank lowest. ``as_written`` keeps the inverted recency and puts missing values last.
    """
    if recency not in ("documented", "as_written"):
        raise ValueError(f"recency must be 'documented' or 'as_written', not {recency!r}")
    documented = recency == "documented"
    last_day = F.datediff(F.col("last_order_date"), F.lit("1970-01-01").cast("date"))
    return {
        "recency_score": Scale(last_day, descending=not documented, nulls_first=documented),
        "frequency_score": Scale(F.col("completed_orders")),
        "monetary_score": Scale(F.col("total_revenue"), nulls_first=documented),
    }


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment by the first rule that fits; the order of the rules matters."""
    # Score rules and their labels.
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "New Customers"),
        ((r >= 3) & (f >= 2) & (m >= 2), "Potential Loyalists"),
        ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
        ((r == 1) & (f >= 3), "Cannot Lose Them"),
        ((r <= 2) & (f <= 2), "Hibernating"),
    ]
    out = F.when(*rules[0])
    for rule in rules[1:]:
        out = out.when(*rule)
    return out.otherwise("Promising")


def rfm_scores(order_stats: DataFrame, recency: str = "documented") -> DataFrame:
    """``order_stats`` with the three scores, their mean and the segment.

    The statistics are stored first: the ranking reads them, and the result reads them again.
    """
    order_stats, _ = scratch.store(order_stats, "order-stats")
    scores = ntile_columns(order_stats, "customer_id", rfm_scales(recency), k=5)
    r, f, m = (F.col(n) for n in scores)
    return order_stats.withColumns(scores).withColumns({
        "rfm_avg": ratio((r + f + m).cast("decimal(10,0)"), F.lit(3).cast("decimal(1,0)")).cast("decimal(5,2)"),
        "rfm_segment": rfm_segment(r, f, m),
    })


def dim_customers(customers: DataFrame, order_stats: DataFrame, recency: str = "documented") -> DataFrame:
    """Every customer with order statistics, scores, segment and tier."""
    scored = rfm_scores(order_stats, recency)
    value = F.coalesce("total_revenue", F.lit(0).cast("decimal(18,2)"))

    def or_zero(name: str, as_type: str) -> Column:
        return F.coalesce(name, F.lit(0).cast(as_type)).alias(name)

    return customers.join(scored, "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "full_name", "email", "city", "state", "country",
        "customer_segment", "registration_date",
        or_zero("total_orders", "long"), or_zero("completed_orders", "long"), or_zero("cancelled_orders", "long"),
        value.alias("lifetime_value"),
        or_zero("avg_order_value", "decimal(18,6)"),
        "first_order_date", "last_order_date", "customer_age_days",
        or_zero("avg_items_per_order", "decimal(18,2)"), or_zero("cancellation_rate_pct", "decimal(18,2)"),
        "recency_score", "frequency_score", "monetary_score", "rfm_avg",
        F.coalesce("rfm_segment", F.lit(NO_ORDERS)).alias("rfm_segment"),
        bands(value, CUSTOMER_TIERS, CUSTOMER_REST).alias("customer_tier"),
    )


def dim_products(products: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every product with its sales and performance tier."""
    sales = metrics.select("product_id", "total_orders", "units_sold", "gross_revenue", "gross_profit",
                           "avg_selling_price", "sell_through_rate_pct", "last_order_date", "first_order_date")
    revenue = F.coalesce("gross_revenue", F.lit(0).cast("decimal(18,2)"))

    def or_zero(name: str, as_type: str) -> Column:
        return F.coalesce(name, F.lit(0).cast(as_type)).alias(name)

    return products.join(sales, "product_id", "left").select(
        "product_id", "product_name", "category", "subcategory", "brand", "cost_price", "selling_price",
        "margin_pct", "margin_tier", "stock_quantity", "stock_status", "sku",
        or_zero("total_orders", "long"), or_zero("units_sold", "long"),
        revenue.alias("gross_revenue"), or_zero("gross_profit", "decimal(18,2)"),
        F.coalesce("avg_selling_price", F.col("selling_price").cast("decimal(18,6)")).alias("avg_selling_price"),
        or_zero("sell_through_rate_pct", "decimal(18,2)"),
        "last_order_date", "first_order_date",
        bands(revenue, PRODUCT_TIERS, PRODUCT_REST).alias("performance_tier"),
    )
