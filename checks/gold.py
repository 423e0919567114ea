"""Models and reports: each query with its comparison SQL."""

from __future__ import annotations

from checks import sql as S
from checks.retail import Retail
from checks.sql import average, cents, n, query, quotient, total
from tallyhouse.plans import cohorts, dimensions, marketing, metrics, reports

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, build, text: str | None = None) -> None:
    QUERIES[name] = lambda spark, folder: build(Retail(spark, folder))
    if text is not None:
        SQL[name] = text


# --- models ---------------------------------------------------------------------------------------

add("mdl1_stg_customers", lambda r: r.customers.drop("updated_at"), query(S.SILVER, "SELECT * FROM cust"))
add("mdl2_stg_products", lambda r: r.products.drop("updated_at"), query(S.STAGED, "SELECT * FROM s_prod"))
add("mdl3_stg_orders", lambda r: r.orders.drop("updated_at"), query(S.STAGED, "SELECT * FROM s_ord"))
add("mdl4_stg_order_items", lambda r: r.items.drop("updated_at"), query(S.STAGED, "SELECT * FROM s_item"))
add("mdl5_int_customer_orders", lambda r: r.customer_orders, query(S.STAGED + [S.CUSTOMER_ORDERS], "SELECT * FROM cust_ord"))
add("mdl6_int_product_metrics", lambda r: r.product_metrics, query(S.STAGED + [S.PRODUCT_METRICS], "SELECT * FROM prod_met"))

# The spine covers the order dates of the tables, so that it follows the data.
_SPAN = """, span AS (SELECT date_trunc('month', min(order_date)) AS lo, max(order_date) AS hi FROM ord)
SELECT d.* FROM dimd d, span WHERE d.date BETWEEN lo AND hi"""


def _dates_of_orders(r: Retail, **options):
    from pyspark.sql import functions as F

    span = r.orders.agg(F.trunc(F.min("order_date"), "month").alias("lo"), F.max("order_date").alias("hi")).first()
    return dimensions.dim_date(r.spark, span.lo, span.hi, "2001-12-31", **options)


add("mdl7_dim_date", _dates_of_orders, query([S.BASE, S.DATES], "").rstrip() + _SPAN)
add("mdl7_dim_date_padded", lambda r: _dates_of_orders(r, padded_names=True).select("date", "month_name", "day_name"),
    query([S.BASE, S.DATES], "").rstrip() + _SPAN.replace(
        "d.*", "d.date, rpad(d.month_name, 9, ' ') AS month_name, rpad(d.day_name, 9, ' ') AS day_name"))
add("mdl8_dim_customers", lambda r: r.dim_customers, query(S.CUSTOMERS, "SELECT * FROM dimc"))
add("mdl8_dim_customers_as_written",
    lambda r: dimensions.dim_customers(r.customers, r.customer_orders, recency="as_written"),
    query(S.STAGED + [S.CUSTOMER_ORDERS, S.rfm("rfm", "last_order_date DESC NULLS LAST", "LAST"), S.dim_customers()],
          "SELECT * FROM dimc"))
# Customers and products whose sales are held out: only orders before 1996 count.


def _early(r: Retail):
    from pyspark.sql import functions as F

    return r.orders.filter(F.col("order_date") < "1996-01-01")


add("mdl8_dim_customers_unmatched",
    lambda r: dimensions.dim_customers(r.customers, metrics.int_customer_orders(_early(r), r.items)),
    query([S.BASE, S.STAGING.replace(" FROM ord)", " FROM ord WHERE order_date < DATE '1996-01-01')"), S.CUSTOMER_ORDERS, S.rfm(), S.dim_customers()],
          "SELECT * FROM dimc"))
add("mdl9_dim_products", lambda r: r.dim_products, query(S.PRODUCTS, "SELECT * FROM dimp"))
add("mdl9_dim_products_unmatched",
    lambda r: dimensions.dim_products(r.products, metrics.int_product_metrics(r.items, _early(r), r.products)),
    query([S.BASE, S.STAGING.replace(" FROM ord)", " FROM ord WHERE order_date < DATE '1996-01-01')"), S.PRODUCT_METRICS, S.DIM_PRODUCTS],
          "SELECT * FROM dimp"))
add("mdl10_fact_orders", lambda r: r.fact, query(S.CUSTOMERS + [S.DATES, S.FACT], "SELECT * FROM fact"))

_DAILY = f"""
per_day AS (
 SELECT order_date, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(quantity) AS BIGINT) AS units_sold, {total('gross_revenue')} AS gross_revenue, {total('cogs')} AS total_cogs,
  {total('gross_profit')} AS gross_profit,
  CAST(sum(CASE WHEN customer_segment = 'B2C' THEN gross_revenue END) AS DECIMAL(18,2)) AS b2c_revenue,
  CAST(sum(CASE WHEN customer_segment = 'B2B' THEN gross_revenue END) AS DECIMAL(18,2)) AS b2b_revenue
 FROM fact WHERE is_completed GROUP BY order_date),
best AS (
 SELECT order_date, category AS top_category FROM (
  SELECT order_date, category, row_number() OVER (PARTITION BY order_date ORDER BY count(*) DESC, category) AS place
  FROM fact WHERE is_completed GROUP BY order_date, category) WHERE place = 1),
daily AS (
 SELECT p.order_date, CAST(year(p.order_date) AS INT) AS year, CAST(month(p.order_date) AS INT) AS month, month_name,
  CAST(date_trunc('week', p.order_date) AS DATE) AS week, quarter_label, is_weekend, total_orders, unique_customers, units_sold,
  gross_revenue, total_cogs, gross_profit, {quotient(cents('gross_revenue'), 'total_orders * 100', 2)} AS avg_order_value,
  CAST(sum(gross_revenue) OVER (PARTITION BY year(p.order_date) ORDER BY p.order_date ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS ytd_revenue,
  {quotient(f"sum({cents('gross_revenue')}) OVER last7", "count(*) OVER last7 * 100", 2)} AS revenue_7d_avg,
  b2c_revenue, b2b_revenue, top_category
 FROM per_day p JOIN best b ON b.order_date = p.order_date LEFT JOIN dimd d ON d.date = p.order_date
 WINDOW last7 AS (ORDER BY p.order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""

add("mdl11_daily_sales", lambda r: marketing.daily_sales(r.lines, r.dates), query(S.SALES + [_DAILY], "SELECT * FROM daily"))
add("mdl12_customer_ltv", lambda r: r.ltv, query(S.CUSTOMERS + [S.LTV], "SELECT * FROM ltv"))

# --- cohorts --------------------------------------------------------------------------------------

_MONTHLY = f"""
monthly AS (
 SELECT customer_id, order_month AS revenue_month, {total('gross_revenue')} AS monthly_revenue, count(DISTINCT order_id) AS monthly_orders
 FROM fact WHERE is_completed GROUP BY customer_id, order_month),
base AS (SELECT customer_id, CAST(date_trunc('month', registration_date) AS DATE) AS cohort_month FROM cust)"""
_MONTHS = "CAST((year({0}) - year(cohort_month)) * 12 + month({0}) - month(cohort_month) AS INT)"


def _activity(months: str) -> str:
    return f"""SELECT cohort_month, revenue_month, {months} AS months_since_signup,
 count(DISTINCT customer_id) AS active_customers, {total('monthly_revenue')} AS cohort_revenue
FROM base JOIN monthly USING (customer_id) GROUP BY ALL"""


add("ch1_monthly_revenue", lambda r: cohorts.monthly_revenue(r.lines), query(S.SALES + [_MONTHLY], "SELECT * FROM monthly"))
add("ch2_cohort_activity", lambda r: cohorts.cohort_activity(r.customers, r.lines),
    query(S.SALES + [_MONTHLY], _activity(_MONTHS.format("revenue_month"))))
add("ch2_cohort_activity_as_written", lambda r: cohorts.cohort_activity(r.customers, r.lines, offset="as_written"),
    query(S.SALES + [_MONTHLY], _activity(_MONTHS.format("revenue_month") + " % 12")))
add("ch3_cohort_size", lambda r: cohorts.cohort_size(r.customers),
    query(S.SALES + [_MONTHLY], "SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM base GROUP BY cohort_month"))

SINCE = "1995-01-01"


def _retention_sql(months: str) -> str:
    return f"""
retention AS (
 SELECT a.cohort_month, months_since_join, active_customers, cohort_size,
  {quotient('active_customers * 100', 'cohort_size', 1)} AS retention_pct
 FROM (SELECT cohort_month, revenue_month, {months} AS months_since_join, count(DISTINCT customer_id) AS active_customers
   FROM base JOIN monthly USING (customer_id) WHERE revenue_month >= cohort_month GROUP BY ALL) a
  JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM base GROUP BY cohort_month) s ON s.cohort_month = a.cohort_month
 WHERE months_since_join <= 11 AND a.cohort_month >= DATE '{SINCE}')"""


_RETENTION = S.SALES + [_MONTHLY, _retention_sql(_MONTHS.format("revenue_month"))]


def _retention(r: Retail):
    return cohorts.cohort_retention(r.customers, r.lines, since=SINCE)


add("rpt12_cohort_retention", _retention, query(_RETENTION, "SELECT * FROM retention"))
add("rpt12_cohort_retention_as_written", lambda r: cohorts.cohort_retention(r.customers, r.lines, since=SINCE, offset="as_written"),
    query(S.SALES + [_MONTHLY, _retention_sql(_MONTHS.format("revenue_month") + " % 12")], "SELECT * FROM retention"))
add("rpt13_cohort_matrix", lambda r: cohorts.cohort_matrix(_retention(r)),
    query(_RETENTION, "SELECT strftime(cohort_month, '%Y-%m') AS cohort, " + ", ".join(
        f"CAST(coalesce(max(CASE WHEN months_since_join = {i} THEN retention_pct END), 0) AS DECIMAL(18,1)) AS \"Month {i}\"" for i in range(12))
        + " FROM retention GROUP BY 1"))
add("rpt14_retention_curve", lambda r: cohorts.retention_curve(_retention(r)),
    query(_RETENTION, f"SELECT months_since_join, {quotient('sum(CAST(retention_pct * 10 AS BIGINT))', 'count(retention_pct) * 10', 4)} AS retention_pct FROM retention GROUP BY 1"))

# --- overview and sales ---------------------------------------------------------------------------

_KPI = f"""SELECT {total('gross_revenue')} AS total_revenue, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
 CAST(round(avg(CAST(gross_revenue AS DOUBLE) / nullif(quantity, 0)), 2) AS DECIMAL(18,2)) AS avg_order_value, {total('gross_profit')} AS total_profit,
 {quotient(f"100 * sum({cents('gross_profit')})", f"sum({cents('gross_revenue')})", 2)} AS overall_margin_pct
FROM fact WHERE is_completed"""
add("rpt1_kpis", lambda r: reports.kpis(r.lines), query(S.SALES, _KPI))
add("rpt1_kpis_filtered", lambda r: reports.kpis(r.lines, year=1997, segments=["B2B"]),
    query(S.SALES, _KPI + " AND order_year = 1997 AND customer_segment IN ('B2B')"))

_TREND = f"""SELECT order_month AS month, month_name, year, {total('gross_revenue')} AS revenue, count(DISTINCT order_id) AS orders,
 count(DISTINCT customer_id) AS customers FROM fact WHERE is_completed"""
add("rpt2_revenue_trend", lambda r: reports.revenue_trend(r.lines), query(S.SALES, _TREND + " GROUP BY 1, 2, 3"))
add("rpt2_revenue_trend_filtered", lambda r: reports.revenue_trend(r.lines, 1998, ["B2C"]),
    query(S.SALES, _TREND + " AND order_year = 1998 AND customer_segment = 'B2C' GROUP BY 1, 2, 3"))
_CATEGORY = f"""SELECT category, {total('gross_revenue')} AS revenue, {total('gross_profit')} AS profit, count(DISTINCT order_id) AS orders,
 CAST(sum(quantity) AS BIGINT) AS units_sold FROM fact WHERE is_completed GROUP BY category"""
add("rpt3_category_breakdown", lambda r: reports.category_breakdown(r.lines), query(S.SALES, _CATEGORY))
add("rpt4_geo_sales", lambda r: reports.geo_sales(r.lines), query(S.SALES, f"""SELECT customer_state AS state, {total('gross_revenue')} AS revenue,
 count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders
FROM fact WHERE is_completed AND customer_state IS NOT NULL GROUP BY 1"""))


def _series(column: str) -> str:
    return f"""SELECT {column} AS period, {total('gross_revenue')} AS revenue, {total('gross_profit')} AS profit, count(DISTINCT order_id) AS orders,
 count(DISTINCT customer_id) AS customers, CAST(sum(quantity) AS BIGINT) AS units,
 {quotient(f"sum({cents('gross_revenue')})", "count(DISTINCT order_id) * 100", 2)} AS aov
FROM fact WHERE is_completed AND customer_segment IN ('B2C', 'B2B') GROUP BY 1"""


for _grain, _column in (("day", "order_date"), ("week", "order_week"), ("month", "order_month")):
    add(f"rpt5_time_series_{_grain}", lambda r, g=_grain: reports.time_series(r.lines, g), query(S.SALES, _series(_column)))
add("rpt6_order_status", lambda r: reports.order_status(r.lines), query(S.SALES, f"""SELECT order_status, count(DISTINCT order_id) AS orders,
 {total('gross_revenue')} AS revenue FROM fact WHERE customer_segment IN ('B2C', 'B2B') GROUP BY 1"""))
add("rpt7_shipping", lambda r: reports.shipping(r.lines), query(S.SALES, f"""SELECT shipping_method, count(DISTINCT order_id) AS orders,
 {quotient('sum(days_to_ship)', 'count(days_to_ship)', 1)} AS avg_days_to_ship, {total('gross_revenue')} AS revenue
FROM fact WHERE is_completed AND days_to_ship IS NOT NULL GROUP BY 1"""))
add("rpt8_weekday_revenue", lambda r: reports.weekday_revenue(r.lines), query(S.SALES, f"""SELECT order_day_of_week AS dow,
 strftime(order_date, '%a') AS day_name, count(DISTINCT order_id) AS orders, {total('gross_revenue')} AS revenue
FROM fact WHERE is_completed GROUP BY 1, 2"""))
add("rpt9_series_summary", lambda r: reports.series_summary(reports.time_series(r.lines, "month")),
    query(S.SALES + ["\nseries AS (" + _series("order_month") + ")"], f"""SELECT {total('revenue')} AS total_revenue, {total('profit')} AS total_profit,
 {quotient(f"100 * sum({cents('profit')})", f"sum({cents('revenue')})", 1)} AS margin_pct, max(revenue) AS peak_revenue,
 (SELECT period FROM series ORDER BY revenue DESC, period LIMIT 1) AS best_period FROM series"""))
add("rpt28_revenue_share", lambda r: reports.revenue_share(reports.category_breakdown(r.lines)),
    query(S.SALES + ["\nbreakdown AS (" + _CATEGORY + ")"], f"""SELECT category, revenue,
 {quotient('100 * ' + cents('revenue'), f"sum({cents('revenue')}) OVER ()", 2)} AS share_pct FROM breakdown"""))
add("rpt29_star_query", lambda r: reports.segment_month_category(r.lines, r.dates, r.products, r.customers, "NATION_3", "B2C"),
    query(S.SALES, f"""SELECT d.month_name, p.category, {total('f.gross_revenue')} AS revenue
FROM fact f JOIN dimd d ON d.date_id = f.date_id JOIN s_prod p ON p.product_id = f.product_id JOIN cust c ON c.customer_id = f.customer_id
WHERE c.state = 'NATION_3' AND c.customer_segment = 'B2C' GROUP BY 1, 2"""))

# --- customers ------------------------------------------------------------------------------------

_RFM = f"""SELECT rfm_segment, customer_tier, customer_segment, count(customer_id) AS customer_count, {average('lifetime_value')} AS avg_ltv,
 {quotient('sum(CAST(avg_order_value * 1000000 AS HUGEINT))', 'count(*) * 1000000', 2)} AS avg_aov,
 {quotient('sum(completed_orders)', 'count(*)', 2)} AS avg_orders, {total('lifetime_value')} AS total_revenue
FROM dimc WHERE customer_segment IN ('B2C', 'B2B') AND completed_orders >= 1 GROUP BY 1, 2, 3"""
add("rpt10_rfm_segments", lambda r: reports.rfm_segments(r.dim_customers), query(S.CUSTOMERS, _RFM))
add("rpt11_rfm_by_segment", lambda r: reports.rfm_by_segment(reports.rfm_segments(r.dim_customers)),
    query(S.CUSTOMERS + ["\nrep AS (" + _RFM + ")"], f"""SELECT rfm_segment, CAST(sum(customer_count) AS BIGINT) AS customer_count,
 {average('avg_ltv', 4)} AS avg_ltv, {total('total_revenue')} AS total_revenue FROM rep GROUP BY 1"""))
_TOP = """SELECT customer_id, full_name, customer_segment, customer_tier, rfm_segment, lifetime_value, avg_order_value, completed_orders,
 churn_status, days_since_last_order FROM ltv WHERE lifetime_value > 0 ORDER BY lifetime_value DESC, customer_id LIMIT """
_WITH_LTV = S.CUSTOMERS + [S.LTV]
add("rpt15_top_ltv", lambda r: reports.top_ltv(r.ltv), query(_WITH_LTV, _TOP + "500"))
add("rpt16_top_customers", lambda r: reports.top_customers(r.ltv), query(_WITH_LTV, f"""SELECT full_name, customer_segment, customer_tier,
 rfm_segment, lifetime_value, completed_orders, avg_order_value, churn_status FROM ({_TOP} 20)"""))
_CHURN = f"""SELECT churn_status, count(customer_id) AS customers, {total('lifetime_value')} AS at_risk_revenue,
 {average('lifetime_value')} AS avg_ltv FROM ltv"""
add("rpt17_churn_summary", lambda r: reports.churn_summary(r.ltv), query(_WITH_LTV, _CHURN + " GROUP BY 1"))
add("rpt18_at_risk", lambda r: reports.at_risk(reports.churn_summary(r.ltv)),
    query(_WITH_LTV, _CHURN + " WHERE churn_status IN ('Churned', 'At Risk of Churn') GROUP BY 1"))
add("rpt28_ltv_histogram", lambda r: reports.ltv_histogram(reports.top_ltv(r.ltv)),
    query(_WITH_LTV + ["\ntop500 AS (" + _TOP + "500)"], """SELECT bin, customer_tier, count(*) AS customers FROM (
 SELECT customer_tier, CAST(CASE WHEN hi = lo THEN 1 ELSE least(40, 1 + floor((v - lo) * 40 / (hi - lo))) END AS INT) AS bin
 FROM (SELECT customer_tier, CAST(lifetime_value AS DOUBLE) AS v, min(CAST(lifetime_value AS DOUBLE)) OVER () AS lo,
   max(CAST(lifetime_value AS DOUBLE)) OVER () AS hi FROM top500)) GROUP BY 1, 2"""))
add("srt5_ltv_sample", lambda r: reports.ltv_sample(reports.top_ltv(r.ltv)), query(_WITH_LTV + ["\ntop500 AS (" + _TOP + "500)"],
    "SELECT * FROM top500 ORDER BY sha256(customer_id || '|0'), customer_id LIMIT 300"))

# --- products -------------------------------------------------------------------------------------

_PRODUCT_COLUMNS = """product_id, product_name, category, subcategory, brand, selling_price, margin_pct, margin_tier, stock_status,
 total_orders, units_sold, gross_revenue, gross_profit, performance_tier"""


def _top_products(rank: str, limit: int, where: str = "") -> str:
    return f"SELECT {_PRODUCT_COLUMNS} FROM dimp WHERE units_sold > 0 {where} ORDER BY {rank} DESC, product_id LIMIT {limit}"


for _rank in reports.PRODUCT_RANKS:
    add(f"rpt19_top_products_by_{_rank}", lambda r, m=_rank: reports.top_products(r.dim_products, 20, m),
        query(S.PRODUCTS, _top_products(_rank, 20)))
add("rpt19_top_products_of_category", lambda r: reports.top_products(r.dim_products, 50, category="SMALL"),
    query(S.PRODUCTS, _top_products("gross_revenue", 50, "AND category = 'SMALL'")))
add("srt4_chart_rows", lambda r: reports.chart_rows(reports.top_products(r.dim_products, 50), n=20),
    query(S.PRODUCTS, _top_products("gross_revenue", 20)))
add("agg14_top_products_totals", lambda r: reports.top_products_totals(reports.top_products(r.dim_products, 20)),
    query(S.PRODUCTS + ["\ntop20 AS (" + _top_products("gross_revenue", 20) + ")"], f"""SELECT {total('gross_revenue')} AS total_revenue,
 {total('gross_profit')} AS total_profit, {average('margin_pct', 1)} AS avg_margin, CAST(sum(units_sold) AS BIGINT) AS units_sold FROM top20"""))
_MARGIN = f"""SELECT category, subcategory, count(product_id) AS product_count, {average('margin_pct')} AS avg_margin_pct,
 {total('gross_revenue')} AS total_revenue, {total('gross_profit')} AS total_profit, CAST(sum(units_sold) AS BIGINT) AS total_units,
 {average('selling_price')} AS avg_price FROM dimp WHERE units_sold > 0 GROUP BY 1, 2"""
_WITH_MARGIN = S.PRODUCTS + ["\nrep AS (" + _MARGIN + ")"]
add("rpt20_category_margin", lambda r: reports.category_margin(r.dim_products), query(S.PRODUCTS, _MARGIN))
add("rpt21_margin_by_category", lambda r: reports.margin_by_category(reports.category_margin(r.dim_products)),
    query(_WITH_MARGIN, f"""SELECT category, {total('total_revenue')} AS total_revenue, {average('avg_margin_pct', 4)} AS avg_margin_pct,
 CAST(sum(total_units) AS BIGINT) AS total_units FROM rep GROUP BY 1"""))
add("rpt22_margin_tiers", lambda r: reports.margin_tiers(r.dim_products), query(S.PRODUCTS, f"""SELECT margin_tier,
 count(product_id) AS product_count, {average('margin_pct')} AS avg_margin, {total('gross_revenue')} AS revenue
FROM dimp WHERE units_sold > 0 GROUP BY 1"""))
add("rpt23_brands", lambda r: reports.brands(r.dim_products), query(S.PRODUCTS, f"""SELECT brand, category, count(product_id) AS products,
 {total('gross_revenue')} AS revenue, {total('gross_profit')} AS profit, {average('margin_pct')} AS avg_margin,
 CAST(sum(units_sold) AS BIGINT) AS units_sold FROM dimp WHERE units_sold > 0 GROUP BY 1, 2 ORDER BY revenue DESC, brand, category LIMIT 20"""))
add("rpt24_inventory", lambda r: reports.inventory(r.dim_products), query(S.PRODUCTS, """SELECT stock_status, category,
 count(product_id) AS product_count, CAST(sum(stock_quantity) AS BIGINT) AS total_units FROM dimp GROUP BY 1, 2"""))
add("rpt25_out_of_stock", lambda r: reports.out_of_stock(r.dim_products), query(S.PRODUCTS, """SELECT product_id, product_name, category, brand,
 units_sold, gross_revenue FROM dimp WHERE stock_status = 'Out of Stock' AND units_sold > 0 ORDER BY gross_revenue DESC, product_id LIMIT 20"""))
add("rpt26_tier_counts", lambda r: reports.tier_counts(reports.top_products(r.dim_products, 20)),
    query(S.PRODUCTS + ["\ntop20 AS (" + _top_products("gross_revenue", 20) + ")"],
          "SELECT performance_tier, count(*) AS products FROM top20 GROUP BY 1"))
_WEIGHTED = f"sum({cents('avg_margin_pct')}::HUGEINT * {cents('total_revenue')})"
add("rpt28_category_tree", lambda r: reports.category_tree(reports.category_margin(r.dim_products)),
    query(_WITH_MARGIN, f"""SELECT category, subcategory, CAST(grouping(category, subcategory) AS INT) AS level, {total('total_revenue')} AS revenue,
 {quotient(_WEIGHTED, f"sum({cents('total_revenue')}) * 100", 4)} AS avg_margin_pct FROM rep GROUP BY ROLLUP (category, subcategory)"""))
