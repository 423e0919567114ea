"""Daily sales and customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import bands, counted, mean, money, ratio
from tallyhouse.schemas import MONEY

# Days since the last completed order.
CHURN_STATES = (("Churned", 365, "gt"), ("At Risk of Churn", 180, "gt"), ("Needs Attention", 90, "gt"))
CHURN_REST = "Active"
NEVER_PURCHASED = "Never Purchased"


def top_category(fact: DataFrame) -> DataFrame:
    """Most frequent category of the completed lines per day; the first in the alphabet on a tie."""
    counts = fact.filter("is_completed").groupBy("order_date", "category").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("category").isNotNull(), F.struct((-F.col("n")).alias("n"), "category")))
    return counts.groupBy("order_date").agg(best.getField("category").alias("top_category"))


def day_totals(fact: DataFrame) -> DataFrame:
    """Additive and distinct measures and the top category per day with a completed order.

    One pass over the lines: they are grouped by order and, beside that, by category; then by customer;
    then by day. A row of the second kind only carries the number of lines of its category.
    """
    revenue, segment = F.col("gross_revenue"), F.col("customer_segment")
    sums = {
        "units_sold": F.col("quantity"),
        "revenue": revenue,
        "cogs": F.col("cogs"),
        "profit": F.col("gross_profit"),
        "b2c": F.when(segment == "B2C", revenue),
        "b2b": F.when(segment == "B2B", revenue),
    }
    lines = fact.filter("is_completed").select("order_date", "order_id", "customer_id", "category", *[c.alias(n) for n, c in sums.items()])
    keys = [F.col(c) for c in ("order_date", "order_id", "customer_id", "category")]
    first = lines.groupingSets([keys[:3], [keys[0], keys[3]]], *keys).agg(
        F.grouping("category").cast("boolean").alias("of_order"), F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in sums])
    of_order = F.col("of_order")
    second = first.groupBy("order_date", "customer_id", "category", "of_order").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in sums])
    best = F.min(F.when(~of_order & F.col("category").isNotNull(), F.struct((-F.col("n")).alias("n"), "category")))
    totals = second.groupBy("order_date").agg(
        F.sum(F.when(of_order, F.col("orders"))).alias("total_orders"),
        F.count_if(of_order & F.col("customer_id").isNotNull()).alias("unique_customers"),
        *[F.sum(F.when(of_order, F.col(n))).alias(n) for n in sums],
        best.getField("category").alias("top_category"))
    return totals.select(
        "order_date", "total_orders", "unique_customers", "units_sold",
        money(F.col("revenue")).alias("gross_revenue"),
        money(F.col("cogs")).alias("total_cogs"),
        money(F.col("profit")).alias("gross_profit"),
        money(F.col("b2c")).alias("b2c_revenue"),
        money(F.col("b2b")).alias("b2b_revenue"),
        "top_category",
    )


def with_running_measures(totals: DataFrame, dates: DataFrame) -> DataFrame:
    """Day totals with calendar labels, year-to-date revenue and the seven-row mean.

    The windows run over one row per day, not over the lines. Labels are NULL for days outside ``dates``.
    """
    revenue, day = F.col("gross_revenue"), F.col("order_date")
    so_far = Window.partitionBy("year").orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    last_seven = Window.orderBy("order_date").rowsBetween(-6, 0)
    labels = dates.select(F.col("date").alias("order_date"), "month_name", "quarter_label", "is_weekend")
    return (
        totals.join(labels, "order_date", "left")
        .withColumns({"year": F.year(day), "month": F.month(day), "week": D.week_start(day)})
        .select(
            "order_date", "year", "month", "month_name", "week", "quarter_label", "is_weekend",
            "total_orders", "unique_customers", "units_sold", "gross_revenue", "total_cogs", "gross_profit",
            mean(revenue, F.col("total_orders")).alias("avg_order_value"),
            money(F.sum(revenue).over(so_far)).alias("ytd_revenue"),
            ratio(F.sum(revenue).over(last_seven), counted(F.count(revenue).over(last_seven))).cast(MONEY).alias("revenue_7d_avg"),
            "b2c_revenue", "b2b_revenue", "top_category",
        )
    )


def daily_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per day with a completed order."""
    return with_running_measures(day_totals(fact), dates)


def refresh_days(daily: DataFrame, fact: DataFrame, dates: DataFrame, touched: DataFrame) -> DataFrame:
    """``daily`` with the days in ``touched`` recomputed from ``fact`` and all running measures renewed.

    Only lines of touched days are used again, and only their months are read from a fact that is
    partitioned by month; the running measures come from the per-day rows.
    """
    days = touched.select("order_date").distinct()
    months = [r[0] for r in days.select(D.month_start(F.col("order_date"))).distinct().collect()]  # calendar months
    lines = fact.filter(F.col("order_month").isin(*months)) if months else fact.limit(0)
    fresh = day_totals(lines.join(days, "order_date", "left_semi"))
    kept = daily.select(*fresh.columns).join(days, "order_date", "left_anti")
    return with_running_measures(kept.unionByName(fresh), dates)


def customer_ltv(customers: DataFrame, as_of=None) -> DataFrame:
    """Every customer with projected annual value and churn state as of a day."""
    age = F.col("customer_age_days")
    idle = F.datediff(D.as_date(as_of), F.col("last_order_date"))
    # Orders per day times 365 times their mean value, in exact arithmetic.
    yearly = ratio(F.col("completed_orders").cast("decimal(10,0)") * F.lit(365) * F.col("avg_order_value"), age.cast("decimal(10,0)"))
    projected = F.when((age > 30) & (F.col("completed_orders") > 1), yearly.cast("decimal(18,6)"))
    state = F.when(F.col("last_order_date").isNull(), NEVER_PURCHASED).otherwise(bands(idle, CHURN_STATES, CHURN_REST))
    return customers.select(
        "customer_id", "full_name", "customer_segment", "state", "registration_date", "rfm_segment",
        "customer_tier", "total_orders", "completed_orders", "lifetime_value", "avg_order_value",
        "first_order_date", "last_order_date", "customer_age_days",
        F.coalesce(projected, F.col("avg_order_value")).alias("projected_annual_value"),
        state.alias("churn_status"),
        idle.alias("days_since_last_order"),
    )
