"""Business reports. Each takes gold tables and filters and returns a DataFrame.

``fact`` is the order-line fact, or for reports on overview and sales also the stored ``Summaries``; ``customers`` / ``products`` the dimensions, ``ltv`` the customer
lifetime table. ``year`` and ``segments`` narrow a report; ``None`` means no filter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import counted, mean, mean_of, money, ratio
from tallyhouse.operators.distinct import sales_rollup
from tallyhouse.plans.summaries import Summaries, all_of, measures
from tallyhouse.schemas import MONEY

# Choices of the report pages.
BOTH_SEGMENTS = ("B2C", "B2B")
GRAINS = {"day": "order_date", "week": "order_week", "month": "order_month"}
PRODUCT_RANKS = ("gross_revenue", "units_sold", "gross_profit", "total_orders")
AT_RISK_STATES = ("At Risk of Churn", "Churned")


def _year(year: int | None) -> Column | None:
    """Orders of a year, as a range of months: the column the stored fact is partitioned by."""
    if year is None:
        return None
    return F.col("order_month").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 1)))


def _segments(segments: Iterable[str] | None) -> Column | None:
    chosen = list(segments or ())
    return F.col("customer_segment").isin(*chosen) if chosen else None


def _pick(name: str, allowed: Iterable[str]) -> str:
    if name not in allowed:
        raise ValueError(f"{name!r} is not one of {sorted(allowed)}")
    return name


Sales = DataFrame | Summaries


def _rollup(fact: Sales, keys: dict[str, Column], sums: Iterable[str], year: int | None = None, segments: Iterable[str] | None = None,
            completed: bool = True, known: str | None = None, orders: str = "orders", customers: str | None = "customers") -> DataFrame:
    """Sums, order and customer counts per key over the fact or its summaries. ``known``: a column that must not be NULL."""
    wanted, done = [_year(year), _segments(segments)], F.col("is_completed") if completed else None
    if isinstance(fact, Summaries):
        state = F.col("customer_state").isNotNull() if known == "customer_state" else None
        shipped = F.col("shipped") if known == "days_to_ship" else None
        # Categories and customers are summarised over completed orders alone.
        apart = all_of([*wanted, state])
        whole = apart if "category" in keys else all_of([*wanted, state, shipped, done])
        return fact.rollup(keys, list(sums), whole, apart, orders, customers)
    lines = fact.filter(all_of([done, *wanted, F.col(known).isNotNull() if known else None]))
    for name, key in keys.items():
        lines = lines.withColumn(name, key)
    every = measures()
    return sales_rollup(lines, list(keys), {n: every[n] for n in sums}, orders, customers)


def _columns(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


# --- overview -------------------------------------------------------------------------------------


def kpis(fact: Sales, year: int | None = None, segments: Iterable[str] | None = None) -> DataFrame:
    """One row of headline figures.

    ``avg_order_value`` is the mean effective unit price per line, under the name the report gives it.
    """
    totals = _rollup(fact, {}, ["revenue", "profit", "prices", "priced"], year, segments,
                     orders="total_orders", customers="unique_customers")
    return totals.select(
        money(F.col("revenue")).alias("total_revenue"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"), "unique_customers",
        mean(F.col("prices"), F.col("priced")).alias("avg_order_value"),
        money(F.col("profit")).alias("total_profit"),
        ratio(F.col("profit"), F.col("revenue"), 2, times=100).cast(MONEY).alias("overall_margin_pct"),
    )


def revenue_trend(fact: Sales, year: int | None = None, segments: Iterable[str] | None = None) -> DataFrame:
    """Revenue, orders and customers per month."""
    return _rollup(fact, _columns("order_month", "month_name", "year"), ["revenue"], year, segments).select(
        F.col("order_month").alias("month"), "month_name", "year", money(F.col("revenue")).alias("revenue"),
        "orders", "customers",
    ).orderBy("month")


def category_breakdown(fact: Sales, year: int | None = None, segments: Iterable[str] | None = None) -> DataFrame:
    """Completed sales per category, highest revenue first."""
    return _rollup(fact, _columns("category"), ["revenue", "profit", "units"], year, segments, customers=None).select(
        "category", money(F.col("revenue")).alias("revenue"), money(F.col("profit")).alias("profit"), "orders",
        F.col("units").alias("units_sold"),
    ).orderBy(F.desc_nulls_last("revenue"), "category")


def revenue_share(breakdown: DataFrame) -> DataFrame:
    """Percentage of the total revenue per row of a category breakdown."""
    total = F.sum("revenue").over(Window.partitionBy(F.lit(1)))
    return breakdown.select("category", "revenue", ratio(F.col("revenue"), total, 2, times=100).cast(MONEY).alias("share_pct"))


def geo_sales(fact: Sales, year: int | None = None) -> DataFrame:
    """Completed sales per state; rows without a state are left out."""
    return _rollup(fact, _columns("customer_state"), ["revenue"], year, known="customer_state").select(
        F.col("customer_state").alias("state"), money(F.col("revenue")).alias("revenue"), "customers", "orders",
    ).orderBy(F.desc_nulls_last("revenue"), "state")


# --- sales ----------------------------------------------------------------------------------------


def time_series(fact: Sales, grain: str = "day", year: int | None = None,
                segments: Iterable[str] | None = BOTH_SEGMENTS) -> DataFrame:
    """Completed sales per day, week or month."""
    column = GRAINS[_pick(grain, GRAINS)]
    return _rollup(fact, _columns(column), ["revenue", "profit", "units"], year, segments or BOTH_SEGMENTS).select(
        F.col(column).alias("period"),
        money(F.col("revenue")).alias("revenue"), money(F.col("profit")).alias("profit"),
        "orders", "customers", "units", mean(F.col("revenue"), F.col("orders")).alias("aov"),
    ).orderBy("period")


def order_status(fact: Sales, year: int | None = None, segments: Iterable[str] | None = BOTH_SEGMENTS) -> DataFrame:
    """Orders and revenue per status, all statuses."""
    totals = _rollup(fact, _columns("order_status"), ["revenue"], year, segments or BOTH_SEGMENTS, completed=False, customers=None)
    return totals.select("order_status", "orders", money(F.col("revenue")).alias("revenue")).orderBy(F.desc("orders"), "order_status")


def shipping(fact: Sales, year: int | None = None) -> DataFrame:
    """Orders, revenue and mean days to ship per method. The mean is over order lines."""
    per_method = _rollup(fact, _columns("shipping_method"), ["revenue", "days", "lines"], year, known="days_to_ship", customers=None)
    return per_method.select(
        "shipping_method", "orders",
        mean(F.col("days").cast("decimal(20,0)"), F.col("lines"), 1).alias("avg_days_to_ship"),
        money(F.col("revenue")).alias("revenue"),
    ).orderBy(F.desc("orders"), "shipping_method")


def weekday_revenue(fact: Sales, year: int | None = None) -> DataFrame:
    """Completed orders and revenue per day of the week, Sunday = 0."""
    day = {"dow": D.day_number(F.col("order_date")), "day_name": F.date_format("order_date", "EEE")}
    return _rollup(fact, day, ["revenue"], year, customers=None).select(
        "dow", "day_name", "orders", money(F.col("revenue")).alias("revenue"),
    ).orderBy("dow")


def series_summary(series: DataFrame) -> DataFrame:
    """Totals, margin, peak and best period (the earliest on a tie) of a time series."""
    revenue, profit = F.sum("revenue"), F.sum("profit")
    best = F.min(F.when(F.col("revenue").isNotNull(), F.struct((-F.col("revenue")).alias("lowest"), "period")))
    return series.agg(
        money(revenue).alias("total_revenue"), money(profit).alias("total_profit"),
        F.coalesce(ratio(profit, revenue, 1, times=100), F.lit(0)).cast("decimal(18,1)").alias("margin_pct"),
        F.max("revenue").alias("peak_revenue"), best.getField("period").alias("best_period"),
    )


# --- customers ------------------------------------------------------------------------------------


def rfm_segments(customers: DataFrame, segments: Iterable[str] | None = BOTH_SEGMENTS, min_orders: int = 1) -> DataFrame:
    """Customers and their value per RFM segment, tier and B2B/B2C."""
    chosen = customers.filter(all_of([_segments(segments or BOTH_SEGMENTS), F.col("completed_orders") >= min_orders]))
    return chosen.groupBy("rfm_segment", "customer_tier", "customer_segment").agg(
        F.count("customer_id").alias("customer_count"),
        mean_of(F.col("lifetime_value")).alias("avg_ltv"),
        mean_of(F.col("avg_order_value")).alias("avg_aov"),
        mean_of(counted(F.col("completed_orders"))).alias("avg_orders"),
        money(F.sum("lifetime_value")).alias("total_revenue"),
    ).orderBy(F.desc_nulls_last("total_revenue"), "rfm_segment", "customer_tier", "customer_segment")


def rfm_by_segment(report: DataFrame, weighted: bool = False) -> DataFrame:
    """RFM report per segment. The value is the plain mean of the row means unless ``weighted``."""
    if weighted:
        value = mean(F.sum("total_revenue"), F.sum("customer_count"), 4)
    else:
        value = mean_of(F.col("avg_ltv"), 4)
    return report.groupBy("rfm_segment").agg(
        F.sum("customer_count").alias("customer_count"), value.alias("avg_ltv"),
        money(F.sum("total_revenue")).alias("total_revenue"),
    ).orderBy("rfm_segment")


def top_ltv(ltv: DataFrame, n: int = 500) -> DataFrame:
    """The n customers of highest lifetime value."""
    return ltv.filter(F.col("lifetime_value") > 0).select(
        "customer_id", "full_name", "customer_segment", "customer_tier", "rfm_segment", "lifetime_value",
        "avg_order_value", "completed_orders", "churn_status", "days_since_last_order",
    ).orderBy(F.desc("lifetime_value"), "customer_id").limit(n)


def top_customers(ltv: DataFrame, n: int = 20) -> DataFrame:
    return top_ltv(ltv, n).select(
        "full_name", "customer_segment", "customer_tier", "rfm_segment", "lifetime_value", "completed_orders",
        "avg_order_value", "churn_status")


def ltv_sample(top: DataFrame, n: int = 300, seed: int = 0) -> DataFrame:
    """Sample of at most n rows of the top list, in the order of a hash of customer and seed: the same on every run."""
    return top.orderBy(F.sha2(F.concat_ws("|", F.col("customer_id"), F.lit(str(seed))), 256), "customer_id").limit(n)


def ltv_histogram(top: DataFrame, bins: int = 40) -> DataFrame:
    """Customers per equal-width value bin and tier. The top bin includes the maximum."""
    value = F.col("lifetime_value").cast("double")
    low, high = top.agg(F.min(value), F.max(value)).first()
    if low is None or low == high:
        bin_no = F.lit(1)
    else:
        # width_bucket puts the upper bound itself into bin + 1.
        bin_no = F.least(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return top.select("customer_tier", bin_no.cast("int").alias("bin")).groupBy("bin", "customer_tier").agg(
        F.count(F.lit(1)).alias("customers")).orderBy("bin", "customer_tier")


def churn_summary(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("churn_status").agg(
        F.count("customer_id").alias("customers"),
        money(F.sum("lifetime_value")).alias("at_risk_revenue"),
        mean_of(F.col("lifetime_value")).alias("avg_ltv"),
    ).orderBy(F.desc("customers"), "churn_status")


def at_risk(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("churn_status").isin(*AT_RISK_STATES))


# --- products -------------------------------------------------------------------------------------


def _sold(products: DataFrame, category: str | None = None) -> DataFrame:
    return products.filter(all_of([
        F.col("units_sold") > 0, None if category is None else F.col("category") == category]))


def top_products(products: DataFrame, n: int = 20, rank_by: str = "gross_revenue", category: str | None = None) -> DataFrame:
    """The n best sold products by a chosen measure."""
    measure = _pick(rank_by, PRODUCT_RANKS)
    return _sold(products, category).select(
        "product_id", "product_name", "category", "subcategory", "brand", "selling_price", "margin_pct",
        "margin_tier", "stock_status", "total_orders", "units_sold", "gross_revenue", "gross_profit",
        "performance_tier",
    ).orderBy(F.desc(measure), "product_id").limit(n)


def chart_rows(top: DataFrame, rank_by: str = "gross_revenue", n: int = 20) -> DataFrame:
    """The last n rows of the list in ascending order, as the bar chart shows them."""
    measure = _pick(rank_by, PRODUCT_RANKS)
    return top.orderBy(F.desc(measure), "product_id").limit(n).orderBy(F.asc(measure), F.desc("product_id"))


def top_products_totals(top: DataFrame) -> DataFrame:
    return top.agg(
        money(F.sum("gross_revenue")).alias("total_revenue"), money(F.sum("gross_profit")).alias("total_profit"),
        mean_of(F.col("margin_pct"), 1).alias("avg_margin"), F.sum("units_sold").alias("units_sold"))


def tier_counts(top: DataFrame) -> DataFrame:
    return top.groupBy("performance_tier").agg(F.count(F.lit(1)).alias("products")).orderBy(
        F.desc("products"), "performance_tier")


def category_margin(products: DataFrame, category: str | None = None) -> DataFrame:
    """Sold products per category and subcategory."""
    return _sold(products, category).groupBy("category", "subcategory").agg(
        F.count("product_id").alias("product_count"),
        mean_of(F.col("margin_pct")).alias("avg_margin_pct"),
        money(F.sum("gross_revenue")).alias("total_revenue"),
        money(F.sum("gross_profit")).alias("total_profit"),
        F.sum("units_sold").alias("total_units"),
        mean_of(F.col("selling_price")).alias("avg_price"),
    ).orderBy(F.desc("total_revenue"), "category", "subcategory")


def margin_by_category(report: DataFrame, weighted: bool = False) -> DataFrame:
    """Category margin report per category; plain mean of the row means unless ``weighted`` by products."""
    if weighted:
        margin = mean(F.sum(F.col("avg_margin_pct") * F.col("product_count")), F.sum("product_count"), 4)
    else:
        margin = mean_of(F.col("avg_margin_pct"), 4)
    return report.groupBy("category").agg(
        money(F.sum("total_revenue")).alias("total_revenue"), margin.alias("avg_margin_pct"),
        F.sum("total_units").alias("total_units"),
    ).orderBy("category")


def category_tree(report: DataFrame) -> DataFrame:
    """Category margin report with subtotals; the margin of a node is weighted by revenue."""
    weight = F.sum(F.col("avg_margin_pct") * F.col("total_revenue"))
    return report.rollup("category", "subcategory").agg(
        F.grouping_id().cast("int").alias("level"),
        money(F.sum("total_revenue")).alias("revenue"),
        ratio(weight, F.sum("total_revenue"), 4).cast("decimal(18,4)").alias("avg_margin_pct"),
    ).orderBy("level", "category", "subcategory")


def margin_tiers(products: DataFrame) -> DataFrame:
    return _sold(products).groupBy("margin_tier").agg(
        F.count("product_id").alias("product_count"),
        mean_of(F.col("margin_pct")).alias("avg_margin"),
        money(F.sum("gross_revenue")).alias("revenue"),
    ).orderBy(F.desc("avg_margin"), "margin_tier")


def brands(products: DataFrame, category: str | None = None, n: int = 20) -> DataFrame:
    """The n brand and category pairs of highest revenue."""
    return _sold(products, category).groupBy("brand", "category").agg(
        F.count("product_id").alias("products"),
        money(F.sum("gross_revenue")).alias("revenue"),
        money(F.sum("gross_profit")).alias("profit"),
        mean_of(F.col("margin_pct")).alias("avg_margin"),
        F.sum("units_sold").alias("units_sold"),
    ).orderBy(F.desc("revenue"), "brand", "category").limit(n)


def inventory(products: DataFrame) -> DataFrame:
    """Stock per status and category, sold or not."""
    return products.groupBy("stock_status", "category").agg(
        F.count("product_id").alias("product_count"), F.sum("stock_quantity").alias("total_units"),
    ).orderBy("stock_status", F.desc("product_count"), "category")


def out_of_stock(products: DataFrame, n: int = 20) -> DataFrame:
    """Best sellers without stock."""
    return _sold(products).filter(F.col("stock_status") == "Out of Stock").select(
        "product_id", "product_name", "category", "brand", "units_sold", "gross_revenue",
    ).orderBy(F.desc("gross_revenue"), "product_id").limit(n)


# --- operations and ad-hoc ------------------------------------------------------------------------


def freshness(run_log: DataFrame) -> DataFrame:
    """End of the last successful run."""
    return run_log.filter(F.col("status") == "success").agg(F.max("completed_at").alias("last_run"))


def segment_month_category(fact: DataFrame, dates: DataFrame, products: DataFrame, customers: DataFrame,
                           state: str, segment: str) -> DataFrame:
    """Star query: revenue per month name and category for one state and segment."""
    who = customers.filter((F.col("state") == state) & (F.col("customer_segment") == segment)).select("customer_id")
    return (
        fact.select("date_id", "product_id", "customer_id", "gross_revenue")
        .join(who, "customer_id")
        .join(dates.select("date_id", "month_name"), "date_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("month_name", "category").agg(money(F.sum("gross_revenue")).alias("revenue"))
        .orderBy("month_name", F.desc("revenue"), "category")
    )
