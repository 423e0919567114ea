"""Analyses the documentation of the model describes on top of its tables."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import dates as D
from tallyhouse.functions.numbers import counted, money, ratio
from tallyhouse.functions.stats import p_of_f, p_of_t
from tallyhouse.operators import scratch
from tallyhouse.operators.order_stats import exact_quantiles, group_quantiles
from tallyhouse.operators.segments import segmented
from tallyhouse.schemas import MONEY

# --- time intelligence over one row per day ----------------------------------------------------------


def to_date_totals(daily: DataFrame) -> DataFrame:
    """Year-, quarter- and month-to-date revenue and 7- and 30-row means per day."""
    day, revenue = F.col("order_date"), F.col("gross_revenue")

    def so_far(*period: Column) -> Column:
        w = Window.partitionBy(*period).orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
        return money(F.sum(revenue).over(w))

    def mean_over(rows: int) -> Column:
        w = Window.orderBy("order_date").rowsBetween(1 - rows, 0)
        return ratio(F.sum(revenue).over(w), counted(F.count(revenue).over(w))).cast(MONEY)

    return daily.select(
        "order_date", "gross_revenue",
        so_far(F.year(day)).alias("ytd_revenue"), so_far(F.trunc(day, "quarter")).alias("qtd_revenue"),
        so_far(F.trunc(day, "month")).alias("mtd_revenue"),
        mean_over(7).alias("revenue_7d_avg"), mean_over(30).alias("revenue_30d_avg"))


def calendar_means(daily: DataFrame, spans: Sequence[int] = (7, 30)) -> DataFrame:
    """Mean revenue a calendar day over the last days, whether they have a row or not.

    A day without a row counts as 0; before a whole span has passed the mean is over the days since the first row.
    """
    day = F.unix_date("order_date")
    whole = Window.orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)

    def mean_over(days: int) -> Column:
        total = F.sum("gross_revenue").over(Window.orderBy(day).rangeBetween(1 - days, 0))
        passed = F.least(F.lit(days), day - F.min(day).over(whole) + 1)
        return ratio(F.coalesce(total, F.lit(0)), counted(passed)).cast(MONEY)

    return daily.select("order_date", "gross_revenue", *[mean_over(n).alias(f"mean_{n}_days") for n in spans])


def month_growth(daily: DataFrame) -> DataFrame:
    """Revenue per month beside the previous month and the same month a year before.

    Joined by calendar month, so a month without sales is not skipped over.
    """
    months = daily.groupBy(D.month_start(F.col("order_date")).alias("month")).agg(money(F.sum("gross_revenue")).alias("revenue"))

    def earlier(n: int, name: str) -> DataFrame:
        return months.select(F.add_months("month", n).alias("month"), F.col("revenue").alias(name))

    def growth(name: str) -> Column:
        return ratio(F.col("revenue") - F.col(name), F.col(name), 2, times=100).cast(MONEY)

    return (
        months.join(earlier(1, "previous_month"), "month", "left").join(earlier(12, "last_year"), "month", "left")
        .withColumns({"mom_pct": growth("previous_month"), "yoy_pct": growth("last_year")}))


# --- product classes ---------------------------------------------------------------------------------


def abc_classes(products: DataFrame, a: str = "0.20", b: str = "0.50") -> DataFrame:
    """A, B or C by the share of total revenue earned before the product, best first; C without revenue."""
    # Read for the total, the scan and the products without revenue.
    products, _ = scratch.store(products.select("product_id", "gross_revenue"), "revenues")
    sold = products.filter(F.col("gross_revenue") > 0)
    total = sold.agg(F.sum("gross_revenue")).first()[0]
    placed = segmented(sold, {"gross_revenue": True, "product_id": False}, running=("gross_revenue", "upto"))
    before = F.col("upto") - F.col("gross_revenue")
    limits = [F.lit((Decimal(x) * (total or 0))).cast("decimal(38,6)") for x in (a, b)]
    classed = placed.select(
        "product_id", "gross_revenue",
        F.when(before < limits[0], "A").when(before < limits[1], "B").otherwise("C").alias("abc_class"))
    unsold = products.filter(F.col("gross_revenue").isNull() | (F.col("gross_revenue") <= 0))
    return classed.unionByName(unsold.select("product_id", "gross_revenue", F.lit("C").alias("abc_class")))


def xyz_classes(fact: DataFrame, x: float = 0.5, y: float = 1.0) -> DataFrame:
    """X, Y or Z by the variation of a product's monthly units over the months it sold in."""
    monthly = fact.filter("is_completed").groupBy("product_id", "order_month").agg(F.sum("quantity").alias("units"))
    variation = F.round(F.stddev_samp("units") / F.avg("units"), 6)
    stats = monthly.groupBy("product_id").agg(F.count(F.lit(1)).alias("months"), variation.alias("variation"))
    v = F.col("variation")
    return stats.withColumn("xyz_class", F.when(v <= x, "X").when(v <= y, "Y").otherwise("Z"))


# --- customer ranks ----------------------------------------------------------------------------------


def spend_ranks(customers: DataFrame) -> DataFrame:
    """Rank inside the state, percent rank and decile over all customers, by lifetime value.

    Customers without a state are ranked among themselves, like those of any state. Two arrangements, by state and
    over all, give all four numbers.
    """
    chosen = customers.select("customer_id", "state", "lifetime_value")
    in_state = segmented(chosen, {"lifetime_value": True}, "state", rank="state_rank", percent="state_percent_rank")
    return segmented(in_state, {"lifetime_value": True, "customer_id": False}, ties=1, rank="overall_rank", percent="percent_rank", tiles=("decile", 10))


def predicted_value(ltv: DataFrame, months: int = 24) -> DataFrame:
    """Projected value over a number of months; nothing for churned customers."""
    gone = F.col("churn_status").isin("Churned", "Never Purchased")
    value = F.round(F.col("projected_annual_value") * F.lit(months) / F.lit(12), 2).cast(MONEY)
    return ltv.select("customer_id", "churn_status", F.when(gone, F.lit(0).cast(MONEY)).otherwise(value).alias("predicted_value"))


NO_CHANNEL = "no_channel"

# --- channel pivot -----------------------------------------------------------------------------------


def channel_pivot(fact: DataFrame, channel: str = "shipping_method", channels: Sequence[str] | None = None) -> DataFrame:
    """Completed revenue per month, one column per channel and one, ``no_channel``, for the rest.

    The channels are looked up when not given, at most spark.sql.pivotMaxValues of them (else an error);
    with given channels the last column holds the revenue of all others.
    """
    done = fact.filter("is_completed")
    if channels is None:
        # Spark limits a pivot to spark.sql.pivotMaxValues columns; the lookup stops at the same bound.
        limit = int(done.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = done.select(channel).filter(F.col(channel).isNotNull()).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"{channel} has more than {limit} values")
        channels = sorted(r[0] for r in found)
    named = F.when(F.col(channel).isin(*channels), F.col(channel)).otherwise(NO_CHANNEL)
    wide = done.withColumn("_channel", named).groupBy("order_month").pivot("_channel", [*channels, NO_CHANNEL]).agg(money(F.sum("gross_revenue")))
    return wide.na.fill(0)


# --- statistics --------------------------------------------------------------------------------------


def describe_amounts(orders: DataFrame, column: str = "total_amount") -> DataFrame:
    """Count, mean, median, deviation, variation, skewness and excess kurtosis of an amount."""
    (median,) = exact_quantiles(orders, column, [0.5])
    v = F.col(column).cast("double")
    return orders.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.lit(median).alias("median"), F.stddev_samp(v).alias("stddev"),
        (F.stddev_samp(v) / F.avg(v)).alias("variation"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"))


def outliers(df: DataFrame, key: str, column: str, z: float = 3.0, modified_z: float = 3.5, fence: float = 1.5) -> DataFrame:
    """Z-score, modified Z-score and quartile-fence flags, their consensus, and the capped value.

    The two columns are stored first, since every statistic is a pass over them.
    """
    df, _ = scratch.store(df.select(key, column), "outliers")
    v = F.col(column).cast("double")
    mean, deviation = df.agg(F.avg(v), F.stddev_pop(v)).first()
    q1, median, q3 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    distances = df.select(F.abs(v - F.lit(median)).alias("d"))
    (mad,) = exact_quantiles(distances, "d", [0.5])
    low, high = (None, None) if q1 is None else (q1 - fence * (q3 - q1), q3 + fence * (q3 - q1))

    def beyond(spread: float | None, center: float | None, limit: float, factor: float = 1.0) -> Column:
        return F.abs(v - F.lit(center)) * factor / F.lit(spread) > limit if spread else F.lit(False)

    flags = {
        "z_outlier": beyond(deviation, mean, z),
        "modified_z_outlier": beyond(mad, median, modified_z, 0.6745),
        "fence_outlier": (v < F.lit(low)) | (v > F.lit(high)),
    }
    votes = reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(False)).cast("int") for f in flags.values()])
    return df.select(key, column, *[F.coalesce(f, F.lit(False)).alias(n) for n, f in flags.items()],
                     (votes >= 2).alias("is_outlier"), F.least(F.greatest(v, F.lit(low)), F.lit(high)).alias("capped"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)])))


def _moments(df: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.filter(v.isNotNull()).groupBy(group).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"))


def welch_t(df: DataFrame, group: str, first: str, second: str, value: str) -> DataFrame:
    """Welch's t statistic and degrees of freedom of two groups."""
    m = _moments(df.filter(F.col(group).isin(first, second)), group, value)

    def of(g: str, c: str) -> Column:
        return F.max(F.when(F.col(group) == g, F.col(c)))

    one = m.agg(*[of(g, c).alias(f"{c}{i}") for i, g in ((1, first), (2, second)) for c in ("n", "mean", "var")])
    e1, e2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    return one.select(
        ((F.col("mean1") - F.col("mean2")) / F.sqrt(e1 + e2)).alias("t"),
        ((e1 + e2) * (e1 + e2) / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))).alias("df"))


def anova_f(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way analysis of variance: F and its degrees of freedom, from per-group moments."""
    m = _moments(df, group, value)
    n, mean, within = F.col("n"), F.col("mean"), (F.col("n") - 1) * F.coalesce("var", F.lit(0.0))
    center = m.agg(F.sum(n * mean) / F.sum("n")).first()[0]
    s = m.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"),
              F.sum(n * (mean - F.lit(center)) * (mean - F.lit(center))).alias("between"), F.sum(within).alias("within"))
    low, high = F.col("k") - 1, F.col("total") - F.col("k")
    return s.select((F.col("between") / low / (F.col("within") / high)).alias("f"), low.alias("df_between"), high.alias("df_within"))


def welch_test(df: DataFrame, group: str, first: str, second: str, value: str) -> DataFrame:
    """``welch_t`` with the two-sided p-value; NULL where a group has fewer than two rows."""
    return welch_t(df, group, first, second, value).withColumn("p_value", p_of_t(F.col("t"), F.col("df")))


def anova_test(df: DataFrame, group: str, value: str) -> DataFrame:
    """``anova_f`` with the p-value."""
    return anova_f(df, group, value).withColumn("p_value", p_of_f(F.col("f"), F.col("df_between"), F.col("df_within")))


# --- row quality -------------------------------------------------------------------------------------


def quality_score(df: DataFrame, rules: Sequence[tuple[Column, int]], name: str = "dq_score") -> DataFrame:
    """Score from 0 to 100: the weight of the rules a row meets over the weight of all."""
    total = sum(w for _, w in rules)
    met = reduce(lambda a, b: a + b, [F.when(rule, w).otherwise(0) for rule, w in rules])
    return df.withColumn(name, ratio(met.cast("decimal(10,0)"), F.lit(total).cast("decimal(10,0)"), 0, times=100).cast("int"))


def describe_by(df: DataFrame, group: str, column: str, fence: float = 1.5) -> DataFrame:
    """Count, exact quartiles, median absolute deviation and quartile fences of a column in each group, with its rows beyond them.

    Groups of any number and size: the quartiles of all of them come from the same two passes.
    """
    rows, _ = scratch.store(df.select(F.col(group).alias("_group"), F.col(column).cast("double").alias("_v")), "describe-by")
    q, _ = scratch.store(group_quantiles(rows, "_v", "_group", {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumnRenamed("_group", "_of"), "quartiles")
    both = rows.join(q, F.col("_group").eqNullSafe(F.col("_of")))
    low, high = F.col("q1") - fence * (F.col("q3") - F.col("q1")), F.col("q3") + fence * (F.col("q3") - F.col("q1"))
    mad = group_quantiles(both.select("_group", F.abs(F.col("_v") - F.col("median")).alias("_d")), "_d", "_group", {"mad": 0.5}).drop("n").withColumnRenamed("_group", "_mad_of")
    beyond = both.groupBy("_group").agg(F.count_if((F.col("_v") < low) | (F.col("_v") > high)).alias("beyond_fences"))
    return q.join(mad, F.col("_of").eqNullSafe(F.col("_mad_of"))).join(beyond, F.col("_of").eqNullSafe(F.col("_group"))).select(
        F.col("_of").alias(group), "n", "q1", "median", "q3", "mad", low.alias("low_fence"), high.alias("high_fence"), "beyond_fences")
