"""Building blocks of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

# Test tables as silver relations.
ADAPTER = """
cust AS (
 SELECT 'CUST-' || lpad(CAST(c_custkey AS STRING),9,'0') AS customer_id,
  split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name, c_name AS full_name,
  lower(replace(c_name,'#','.')) || '@example.com' AS email, CAST(NULL AS STRING) AS phone,
  CAST(NULL AS STRING) AS city, n_name AS state, r_name AS country, CAST(NULL AS STRING) AS zip_code,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'B2B' ELSE 'B2C' END AS customer_segment,
  DATE '1995-01-01' + CAST(c_custkey % 730 AS INT) AS registration_date
 FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey),
prod0 AS (
 SELECT 'PROD-' || lpad(CAST(p_partkey AS STRING),9,'0') AS product_id, p_name AS product_name,
  p_type AS category, split_part(p_name,' ',2) AS subcategory, p_brand AS brand,
  CAST(p_retailprice AS DECIMAL(10,2)) AS selling_price,
  CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.2 + (p_size % 8) * 0.1 AS DECIMAL(3,1)),2) AS DECIMAL(10,2)) AS cost_price,
  CAST(p_partkey % 60 AS INT) AS stock_quantity, 'SKU-' || CAST(p_partkey AS STRING) AS sku FROM part),
prod AS (
 SELECT *, CASE WHEN selling_price > 0 THEN {margin} ELSE 0 END AS margin_pct FROM prod0),
ship AS (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS ship_date FROM lineitem GROUP BY l_orderkey),
ord AS (
 SELECT 'ORD-' || lpad(CAST(o_orderkey AS STRING),9,'0') AS order_id, 'CUST-' || lpad(CAST(o_custkey AS STRING),9,'0') AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, ship_date, CAST(ship_date - CAST(o_orderdate AS DATE) AS INT) AS days_to_ship,
  o_orderpriority AS shipping_method,
  CASE WHEN o_orderstatus='F' THEN 'completed' WHEN o_orderstatus='P' AND o_orderkey%2=0 THEN 'returned' WHEN o_orderstatus='P' THEN 'cancelled' WHEN o_orderkey%2=0 THEN 'shipped' ELSE 'processing' END AS order_status,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
  CASE o_orderkey % 5 WHEN 0 THEN ' SAVE10 ' WHEN 1 THEN '' WHEN 2 THEN 'VIP25' ELSE NULL END AS discount_code
 FROM orders LEFT JOIN ship ON l_orderkey=o_orderkey),
item AS (
 SELECT 'ITEM-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS item_id,
  'ORD-' || lpad(CAST(l_orderkey AS STRING),9,'0') AS order_id, 'PROD-' || lpad(CAST(l_partkey AS STRING),9,'0') AS product_id,
  CAST(l_quantity AS INT) AS quantity, {unit_price} AS unit_price, CAST(l_discount*100 AS DECIMAL(5,2)) AS discount_pct,
  CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))),2) AS DECIMAL(12,2)) AS line_total
 FROM lineitem)"""


def cents(expr: str) -> str:
    """A two-digit decimal as whole cents."""
    return f"CAST(({expr}) * 100 AS BIGINT)"


def whole(expr: str) -> str:
    return f"CAST(({expr}) AS HUGEINT)"


def quotient(num: str, den: str, digits: int, width: int = 18) -> str:
    """num/den of whole numbers, times 10^digits, rounded half away from zero with integer arithmetic.

    DuckDB divides decimals as doubles, which cannot decide ties.
    """
    n, d = f"(({whole(num)}) * {10 ** digits})", f"nullif(({whole(den)}), 0)"
    up = f"((2*abs({n}) + abs({d})) // (2*abs({d})))"
    signed = f"(CASE WHEN ({num} < 0) <> ({den} < 0) THEN -{up} ELSE {up} END)"
    unit = "1" if digits == 0 else f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(CAST({signed} AS DECIMAL({min(width + 2, 30)},0)) * {unit} AS DECIMAL({width},{digits}))"


def total(expr: str) -> str:
    """Sum of a money column."""
    return f"CAST(sum({expr}) AS DECIMAL(18,2))"


def average(expr: str, digits: int = 2, where: str | None = None) -> str:
    """Exact mean of a two-digit decimal column."""
    cond = f" FILTER (WHERE {where})" if where else ""
    return quotient(f"sum({cents(expr)}){cond}", f"count({expr}){cond} * 100", digits)


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


MONEY0 = "CAST(0 AS DECIMAL(18,2))"

BASE = ADAPTER.format(
    margin=quotient(f"({cents('selling_price')} - {cents('cost_price')}) * 100", cents("selling_price"), 2, 5),
    unit_price=quotient(cents("CAST(l_extendedprice AS DECIMAL(12,2))"), "CAST(l_quantity AS INT) * 100", 2, 10),
)

STAGING = f"""
s_prod AS (
 SELECT product_id, product_name, category, coalesce(subcategory,'Other') AS subcategory, brand, cost_price, selling_price, margin_pct,
  stock_quantity, sku,
  CASE WHEN margin_pct >= 60 THEN 'High Margin' WHEN margin_pct >= 40 THEN 'Medium Margin' WHEN margin_pct >= 20 THEN 'Low Margin' ELSE 'Negative Margin' END AS margin_tier,
  CASE WHEN stock_quantity = 0 THEN 'Out of Stock' WHEN stock_quantity < 10 THEN 'Low Stock' WHEN stock_quantity < 50 THEN 'Normal Stock' ELSE 'Well Stocked' END AS stock_status
 FROM prod),
s_ord AS (
 SELECT order_id, customer_id, order_date, ship_date, days_to_ship, shipping_method, order_status, total_amount,
  nullif(trim(discount_code), '') AS discount_code,
  order_status = 'completed' AS is_completed, order_status = 'cancelled' AS is_cancelled, order_status = 'returned' AS is_returned,
  CAST(date_trunc('month', order_date) AS DATE) AS order_month, CAST(date_trunc('week', order_date) AS DATE) AS order_week,
  CAST(year(order_date) AS INT) AS order_year, CAST(month(order_date) AS INT) AS order_month_num,
  CAST(dayofweek(order_date) AS INT) AS order_day_of_week
 FROM ord),
s_item AS (
 SELECT *, {quotient(cents('line_total'), 'quantity * 100', 2, 12)} AS effective_unit_price FROM item)"""

DATES = """
dimd AS (
 SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
  'Q' || quarter(d) AS quarter_label, CAST(month(d) AS INT) AS month, strftime(d, '%b') AS month_short, strftime(d, '%B') AS month_name,
  CAST(weekofyear(d) AS INT) AS week_of_year, CAST(dayofweek(d) AS INT) AS day_of_week, strftime(d, '%A') AS day_name,
  CAST(dayofmonth(d) AS INT) AS day_of_month, CAST(dayofyear(d) AS INT) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month, last_day(d) AS last_day_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter, CAST(date_trunc('year', d) AS DATE) AS first_day_of_year,
  d >= DATE '2001-12-01' AS is_current_month, d >= DATE '2001-01-01' AS is_current_year
 FROM (SELECT CAST(x AS DATE) AS d FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS x)))"""

CUSTOMER_ORDERS = f"""
per_ord AS (
 SELECT o.*, coalesce(item_count, 0) AS item_count
 FROM s_ord o LEFT JOIN (SELECT order_id, count(item_id) AS item_count FROM s_item GROUP BY order_id) c ON c.order_id = o.order_id),
cust_ord AS (
 SELECT customer_id, n_all AS total_orders, n_done AS completed_orders, n_cancelled AS cancelled_orders, n_returned AS returned_orders,
  total_revenue, avg_order_value, max_order_value, last_order_date, first_order_date, customer_age_days, avg_items_per_order, cancellation_rate_pct
 FROM (SELECT customer_id, count(*) AS n_all,
   {n('sum(CASE WHEN is_completed THEN 1 ELSE 0 END)')} AS n_done, {n('sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END)')} AS n_cancelled,
   {n('sum(CASE WHEN is_returned THEN 1 ELSE 0 END)')} AS n_returned,
   CAST(sum(total_amount) FILTER (WHERE is_completed) AS DECIMAL(18,2)) AS total_revenue,
   {average('total_amount', 6, 'is_completed')} AS avg_order_value,
   max(total_amount) FILTER (WHERE is_completed) AS max_order_value,
   max(order_date) FILTER (WHERE is_completed) AS last_order_date, min(order_date) FILTER (WHERE is_completed) AS first_order_date,
   CAST(max(order_date) FILTER (WHERE is_completed) - min(order_date) FILTER (WHERE is_completed) AS INT) AS customer_age_days,
   {quotient('sum(item_count) FILTER (WHERE is_completed)', 'count(*) FILTER (WHERE is_completed)', 2)} AS avg_items_per_order,
   {quotient('100 * count(*) FILTER (WHERE is_cancelled)', 'count(*)', 2)} AS cancellation_rate_pct
  FROM per_ord GROUP BY customer_id))"""

PRODUCT_METRICS = f"""
prod_sales AS (
 SELECT i.product_id, count(DISTINCT o.order_id) AS total_orders,
  count(DISTINCT CASE WHEN is_completed THEN o.order_id END) AS completed_orders,
  CAST(sum(quantity) FILTER (WHERE is_completed) AS BIGINT) AS units_sold,
  CAST(sum(line_total) FILTER (WHERE is_completed) AS DECIMAL(18,2)) AS gross_revenue,
  {average('effective_unit_price', 6, 'is_completed')} AS avg_selling_price,
  max(order_date) AS last_order_date, min(order_date) AS first_order_date
 FROM s_item i JOIN s_ord o ON o.order_id = i.order_id GROUP BY i.product_id),
prod_met AS (
 SELECT s.*, product_name, category, subcategory, brand, cost_price, selling_price, margin_pct, margin_tier, stock_quantity, stock_status,
  CAST(gross_revenue - units_sold * cost_price AS DECIMAL(18,2)) AS gross_profit,
  {quotient(cents('gross_revenue'), 'units_sold * 100', 2)} AS revenue_per_unit,
  {quotient('units_sold * 100', '(units_sold + stock_quantity)', 2)} AS sell_through_rate_pct
 FROM prod_sales s JOIN s_prod p ON p.product_id = s.product_id)"""


def rfm(name: str = "rfm", recency: str = "last_order_date ASC NULLS FIRST", monetary_nulls: str = "FIRST") -> str:
    return f"""
{name} AS (
 SELECT *, {quotient('recency_score + frequency_score + monetary_score', '3', 2, 5)} AS rfm_avg,
  CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
   WHEN least(recency_score, frequency_score, monetary_score) >= 3 THEN 'Loyal Customers'
   WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New Customers'
   WHEN recency_score >= 3 AND least(frequency_score, monetary_score) >= 2 THEN 'Potential Loyalists'
   WHEN recency_score <= 2 AND least(frequency_score, monetary_score) >= 3 THEN 'At Risk'
   WHEN recency_score = 1 AND frequency_score >= 3 THEN 'Cannot Lose Them'
   WHEN greatest(recency_score, frequency_score) <= 2 THEN 'Hibernating' ELSE 'Promising' END AS rfm_segment
 FROM (SELECT *, CAST(ntile(5) OVER (ORDER BY {recency}, customer_id) AS INT) AS recency_score,
   CAST(ntile(5) OVER (ORDER BY completed_orders ASC NULLS LAST, customer_id) AS INT) AS frequency_score,
   CAST(ntile(5) OVER (ORDER BY total_revenue ASC NULLS {monetary_nulls}, customer_id) AS INT) AS monetary_score
  FROM cust_ord))"""


def dim_customers(source: str = "rfm", name: str = "dimc") -> str:
    return f"""
{name} AS (
 SELECT c.customer_id, first_name, last_name, full_name, email, city, state, country, customer_segment, registration_date,
  coalesce(total_orders, 0) AS total_orders, coalesce(completed_orders, 0) AS completed_orders, coalesce(cancelled_orders, 0) AS cancelled_orders,
  coalesce(total_revenue, {MONEY0}) AS lifetime_value, coalesce(avg_order_value, CAST(0 AS DECIMAL(18,6))) AS avg_order_value,
  first_order_date, last_order_date, customer_age_days,
  coalesce(avg_items_per_order, {MONEY0}) AS avg_items_per_order, coalesce(cancellation_rate_pct, {MONEY0}) AS cancellation_rate_pct,
  recency_score, frequency_score, monetary_score, rfm_avg, coalesce(rfm_segment, 'No Orders') AS rfm_segment,
  CASE WHEN total_revenue >= 2000 THEN 'Platinum' WHEN total_revenue >= 1000 THEN 'Gold' WHEN total_revenue >= 300 THEN 'Silver'
   WHEN total_revenue > 0 THEN 'Bronze' ELSE 'Inactive' END AS customer_tier
 FROM cust c LEFT JOIN {source} r ON r.customer_id = c.customer_id)"""


DIM_PRODUCTS = f"""
dimp AS (
 SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.cost_price, p.selling_price, p.margin_pct, p.margin_tier,
  p.stock_quantity, p.stock_status, p.sku, coalesce(m.total_orders, 0) AS total_orders, coalesce(m.units_sold, 0) AS units_sold,
  coalesce(m.gross_revenue, {MONEY0}) AS gross_revenue, coalesce(m.gross_profit, {MONEY0}) AS gross_profit,
  coalesce(m.avg_selling_price, CAST(p.selling_price AS DECIMAL(18,6))) AS avg_selling_price,
  coalesce(m.sell_through_rate_pct, {MONEY0}) AS sell_through_rate_pct, m.last_order_date, m.first_order_date,
  CASE WHEN m.gross_revenue >= 10000 THEN 'Top Performer' WHEN m.gross_revenue >= 3000 THEN 'Strong Performer'
   WHEN m.gross_revenue >= 500 THEN 'Average Performer' WHEN m.gross_revenue > 0 THEN 'Low Performer' ELSE 'No Sales' END AS performance_tier
 FROM s_prod p LEFT JOIN prod_met m ON m.product_id = p.product_id)"""

# Line-level fact without and with the customer scores.
_LINE = """
 SELECT i.item_id, i.order_id, i.product_id, o.customer_id, d.date_id, o.order_date, o.order_status, o.is_completed, o.is_cancelled, o.is_returned,
  o.shipping_method, o.discount_code, o.days_to_ship, o.order_month, o.order_week, o.order_year, o.order_month_num, o.order_day_of_week,
  p.category, p.subcategory, p.brand, p.cost_price AS product_cost, p.margin_pct AS product_margin_pct,
  c.customer_segment, c.state AS customer_state, {extra} d.year, d.quarter, d.quarter_label, d.month, d.month_name, d.week_of_year, d.is_weekend,
  i.quantity, i.unit_price, i.discount_pct, i.line_total AS gross_revenue,
  CAST(i.quantity * p.cost_price AS DECIMAL(14,2)) AS cogs, CAST(i.line_total - i.quantity * p.cost_price AS DECIMAL(14,2)) AS gross_profit
 FROM s_item i JOIN s_ord o ON o.order_id = i.order_id JOIN s_prod p ON p.product_id = i.product_id
  LEFT JOIN {customers} c ON c.customer_id = o.customer_id LEFT JOIN dimd d ON d.date = o.order_date"""
LINES = "\nfact AS (" + _LINE.format(extra="", customers="cust") + ")"
FACT = "\nfact AS (" + _LINE.format(extra="c.rfm_segment, c.customer_tier,", customers="dimc") + ")"

LTV = f"""
ltv AS (
 SELECT customer_id, full_name, customer_segment, state, registration_date, rfm_segment, customer_tier, total_orders, completed_orders,
  lifetime_value, avg_order_value, first_order_date, last_order_date, customer_age_days,
  CASE WHEN customer_age_days > 30 AND completed_orders > 1
   THEN CAST({quotient('completed_orders * 365 * CAST(avg_order_value * 1000000 AS HUGEINT)', 'CAST(customer_age_days AS HUGEINT) * 1000000', 2)} AS DECIMAL(18,6))
   ELSE avg_order_value END AS projected_annual_value,
  CASE WHEN last_order_date IS NULL THEN 'Never Purchased' WHEN idle > 365 THEN 'Churned' WHEN idle > 180 THEN 'At Risk of Churn'
   WHEN idle > 90 THEN 'Needs Attention' ELSE 'Active' END AS churn_status,
  idle AS days_since_last_order
 FROM (SELECT *, CAST(DATE '2001-12-31' - last_order_date AS INT) AS idle FROM dimc))"""

SILVER = [BASE]
STAGED = [BASE, STAGING]
SALES = STAGED + [DATES, LINES]
CUSTOMERS = STAGED + [CUSTOMER_ORDERS, rfm(), dim_customers()]
PRODUCTS = STAGED + [PRODUCT_METRICS, DIM_PRODUCTS]


def query(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body.strip()
