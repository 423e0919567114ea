"""Registration cohorts: size, activity and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import counted, money, percent_of, ratio

# Fixed value: first cohort of the retention report.
DEFAULT_SINCE = "2023-01-01"


def cohort_base(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", D.month_start(F.col("registration_date")).alias("cohort_month"))


def cohort_size(customers: DataFrame) -> DataFrame:
    return cohort_base(customers).groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"))


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Completed revenue and orders per customer and month."""
    return (
        fact.filter("is_completed")
        .groupBy("customer_id", F.col("order_month").alias("revenue_month"))
        .agg(money(F.sum("gross_revenue")).alias("monthly_revenue"), F.count_distinct("order_id").alias("monthly_orders"))
    )


def cohort_activity(customers: DataFrame, fact: DataFrame, offset: str = "total") -> DataFrame:
    """Active customers and revenue per cohort and month; the offset is negative before registration."""
    # A customer has one row per month, so counting rows counts customers.
    return (
        monthly_revenue(fact).join(cohort_base(customers), "customer_id")
        .groupBy("cohort_month", "revenue_month",
                 D.months_between_starts(F.col("revenue_month"), F.col("cohort_month"), offset).alias("months_since_signup"))
        .agg(F.count("customer_id").alias("active_customers"), money(F.sum("monthly_revenue")).alias("cohort_revenue"))
    )


def cohort_retention(customers: DataFrame, fact: DataFrame, since=DEFAULT_SINCE, max_months: int = 11,
                     offset: str = "total") -> DataFrame:
    """Share of each cohort that has a completed order n months after registration."""
    known = customers.filter(F.col("registration_date").isNotNull())
    first = F.lit(since).cast("date")
    # Activity counts from the cohort month on, so earlier months of the fact need not be read.
    active = fact.filter(F.col("is_completed") & (F.col("order_month") >= F.trunc(first, "month"))).select(
        "customer_id", F.col("order_month").alias("activity_month")).distinct()
    counts = (
        active.join(cohort_base(known).filter(F.col("cohort_month") >= first), "customer_id")
        .filter("activity_month >= cohort_month")
        .groupBy("cohort_month", "activity_month",
                 D.months_between_starts(F.col("activity_month"), F.col("cohort_month"), offset).alias("months_since_join"))
        .agg(F.count("customer_id").alias("active_customers"))
        .filter(F.col("months_since_join") <= max_months)
    )
    return counts.join(cohort_size(known), "cohort_month").select(
        "cohort_month", "months_since_join", "active_customers", "cohort_size",
        percent_of(F.col("active_customers"), F.col("cohort_size"), 1).alias("retention_pct"),
    ).orderBy("cohort_month", "months_since_join")


def cohort_matrix(retention: DataFrame, max_months: int = 11) -> DataFrame:
    """One row per cohort, one column per month offset, 0 where nothing happened."""
    names = {i: f"Month {i}" for i in range(max_months + 1)}
    wide = retention.groupBy("cohort_month").pivot("months_since_join", list(names)).agg(F.first("retention_pct"))
    return wide.select(
        D.month_label(F.col("cohort_month")).alias("cohort"),
        *[F.coalesce(F.col(f"`{i}`"), F.lit(0).cast("decimal(18,1)")).alias(n) for i, n in names.items()],
    ).orderBy("cohort")


def retention_curve(retention: DataFrame) -> DataFrame:
    """Mean retention per month offset over the cohorts that have a value."""
    return retention.groupBy("months_since_join").agg(
        ratio(F.sum("retention_pct"), counted(F.count("retention_pct")), 4).cast("decimal(18,4)").alias("retention_pct")
    ).orderBy("months_since_join")
