"""Analyses and history operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dirty
from checks import sql as S
from checks.gold import _DAILY
from checks.retail import Retail
from checks.sql import cents, query, quotient, total
from tallyhouse.operators import history, scratch
from tallyhouse.plans import analysis, marketing

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, build, text: str | None = None) -> None:
    QUERIES[name] = build
    if text is not None:
        SQL[name] = text


def _daily(s, f):
    r = Retail(s, f)
    return marketing.daily_sales(r.lines, r.dates)


def _mean_rows(k: int) -> str:
    w = f"(ORDER BY order_date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return quotient(f"sum({cents('gross_revenue')}) OVER {w}", f"count(*) OVER {w} * 100", 2)


def _to_date(period: str) -> str:
    return (f"CAST(sum(gross_revenue) OVER (PARTITION BY date_trunc('{period}', order_date) ORDER BY order_date "
            "ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2))")


def _rounded(df, *columns: str, digits: int = 6):
    """Floating-point results, rounded where the last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


_DAYS = S.SALES + [_DAILY]
add("ext7_to_date_totals", lambda s, f: analysis.to_date_totals(_daily(s, f)), query(_DAYS, f"""SELECT order_date, gross_revenue,
 {_to_date('year')} AS ytd_revenue, {_to_date('quarter')} AS qtd_revenue, {_to_date('month')} AS mtd_revenue,
 {_mean_rows(7)} AS revenue_7d_avg, {_mean_rows(30)} AS revenue_30d_avg FROM daily"""))


def _growth(x: str) -> str:
    return quotient(f"100 * ({cents('m.revenue')} - {cents(x)})", cents(x), 2)


add("ext7_month_growth", lambda s, f: analysis.month_growth(_daily(s, f)), query(_DAYS + [f"""
m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {total('gross_revenue')} AS revenue FROM daily GROUP BY 1)"""], f"""
SELECT m.month, m.revenue, p.revenue AS previous_month, y.revenue AS last_year, {_growth('p.revenue')} AS mom_pct, {_growth('y.revenue')} AS yoy_pct
FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 1 MONTH LEFT JOIN m y ON y.month = m.month - INTERVAL 12 MONTH"""))

def _abc(s, f) -> DataFrame:
    r = Retail(s, f)
    with scratch.partitions_for(s, r.silver.raw("lineitem").count()):
        return analysis.abc_classes(r.dim_products)


add("ext6_abc_classes", _abc, query(S.PRODUCTS, """
SELECT product_id, gross_revenue, CASE WHEN 5 * (upto - gross_revenue) < whole THEN 'A' WHEN 2 * (upto - gross_revenue) < whole THEN 'B' ELSE 'C' END AS abc_class
FROM (SELECT product_id, gross_revenue, sum(gross_revenue) OVER () AS whole,
  sum(gross_revenue) OVER (ORDER BY gross_revenue DESC, product_id ROWS UNBOUNDED PRECEDING) AS upto FROM dimp WHERE gross_revenue > 0)
UNION ALL SELECT product_id, gross_revenue, 'C' FROM dimp WHERE gross_revenue IS NULL OR gross_revenue <= 0"""))
add("ext6_xyz_classes", lambda s, f: analysis.xyz_classes(Retail(s, f).lines), query(S.SALES, """
SELECT product_id, months, v AS variation, CASE WHEN v <= 0.5 THEN 'X' WHEN v <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class
FROM (SELECT product_id, count(*) AS months, round(stddev_samp(u) / avg(u), 6) AS v
 FROM (SELECT product_id, order_month, sum(quantity) AS u FROM fact WHERE is_completed GROUP BY 1, 2) GROUP BY product_id)"""))
add("ext8_spend_ranks", lambda s, f: analysis.spend_ranks(Retail(s, f).dim_customers), query(S.CUSTOMERS, """
SELECT customer_id, state, lifetime_value, rank() OVER st AS state_rank, percent_rank() OVER st AS state_percent_rank,
 rank() OVER al AS overall_rank, percent_rank() OVER al AS percent_rank,
 CAST(ntile(10) OVER (ORDER BY lifetime_value DESC, customer_id) AS INT) AS decile
FROM dimc WINDOW st AS (PARTITION BY state ORDER BY lifetime_value DESC), al AS (ORDER BY lifetime_value DESC)"""))
_METHODS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
add("ext9_channel_pivot", lambda s, f: analysis.channel_pivot(Retail(s, f).lines), query(S.SALES, "SELECT order_month, " + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN shipping_method = '{m}' THEN gross_revenue END), 0) AS DECIMAL(18,2)) AS \"{m}\"" for m in _METHODS) + ", CAST(0 AS DECIMAL(18,2)) AS no_channel"
    + " FROM fact WHERE is_completed GROUP BY 1"))

add("ext10_describe_amounts", lambda s, f: _rounded(analysis.describe_amounts(Retail(s, f).orders), "mean", "median", "stddev", "variation", "skewness", "kurtosis", digits=4),
    query(S.STAGED, """SELECT n, round(mean, 4) AS mean, round(median, 4) AS median, round(sd, 4) AS stddev, round(sd / mean, 4) AS variation,
 round((s3 / n) / power(s2 / n, 1.5), 4) AS skewness, round((s4 / n) / power(s2 / n, 2) - 3, 4) AS kurtosis
FROM (SELECT count(*) AS n, any_value(mean) AS mean, quantile_cont(v, 0.5) AS median, stddev_samp(v) AS sd,
  sum(power(v - mean, 2)) AS s2, sum(power(v - mean, 3)) AS s3, sum(power(v - mean, 4)) AS s4
 FROM (SELECT CAST(total_amount AS DOUBLE) AS v, avg(CAST(total_amount AS DOUBLE)) OVER () AS mean FROM s_ord))"""))
add("ext4_outliers", lambda s, f: _rounded(analysis.outliers(Retail(s, f).orders, "order_id", "total_amount", z=1.6, modified_z=1.2, fence=0.3), "capped", digits=4),
    query(S.STAGED + ["""
v AS (SELECT order_id, total_amount, CAST(total_amount AS DOUBLE) AS v FROM s_ord),
m AS (SELECT avg(v) AS mean, stddev_pop(v) AS sd, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM v),
d AS (SELECT quantile_cont(abs(v - med), 0.5) AS mad FROM v, m),
flagged AS (SELECT order_id, total_amount, v, abs(v - mean) / sd > 1.6 AS z_outlier, abs(v - med) * 0.6745 / mad > 1.2 AS modified_z_outlier,
 v < q1 - 0.3 * (q3 - q1) OR v > q3 + 0.3 * (q3 - q1) AS fence_outlier, q1 - 0.3 * (q3 - q1) AS lo, q3 + 0.3 * (q3 - q1) AS hi FROM v, m, d)"""],
          """SELECT order_id, total_amount, z_outlier, modified_z_outlier, fence_outlier,
 CAST(z_outlier AS INT) + CAST(modified_z_outlier AS INT) + CAST(fence_outlier AS INT) >= 2 AS is_outlier, round(least(greatest(v, lo), hi), 4) AS capped FROM flagged"""))
_SPREAD = ("q1", "median", "q3", "mad", "low_fence", "high_fence")
add("ext10_describe_by_category", lambda s, f: _rounded(analysis.describe_by(Retail(s, f).lines, "category", "gross_revenue", fence=0.5), *_SPREAD, digits=4),
    query(S.SALES + ["""
v AS (SELECT category, CAST(gross_revenue AS DOUBLE) AS v FROM fact),
q AS (SELECT category, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1),
d AS (SELECT category, quantile_cont(abs(v - median), 0.5) AS mad FROM v JOIN q USING (category) GROUP BY 1),
b AS (SELECT category, count(*) FILTER (WHERE v < q1 - 0.5 * (q3 - q1) OR v > q3 + 0.5 * (q3 - q1)) AS beyond_fences FROM v JOIN q USING (category) GROUP BY 1)"""],
          """SELECT category, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(mad, 4) AS mad,
 round(q1 - 0.5 * (q3 - q1), 4) AS low_fence, round(q3 + 0.5 * (q3 - q1), 4) AS high_fence, beyond_fences FROM q JOIN d USING (category) JOIN b USING (category)"""))
add("ext10_correlations", lambda s, f: _rounded(analysis.correlations(Retail(s, f).dim_products, ["selling_price", "units_sold", "gross_revenue"]), "correlation"),
    query(S.PRODUCTS, """SELECT 'selling_price' AS "left", 'units_sold' AS "right", round(corr(CAST(selling_price AS DOUBLE), CAST(units_sold AS DOUBLE)), 6) AS correlation FROM dimp
UNION ALL SELECT 'selling_price', 'gross_revenue', round(corr(CAST(selling_price AS DOUBLE), CAST(gross_revenue AS DOUBLE)), 6) FROM dimp
UNION ALL SELECT 'units_sold', 'gross_revenue', round(corr(CAST(units_sold AS DOUBLE), CAST(gross_revenue AS DOUBLE)), 6) FROM dimp"""))
add("ext11_welch_t", lambda s, f: _rounded(analysis.welch_t(Retail(s, f).dim_customers, "customer_segment", "B2B", "B2C", "lifetime_value"), "t", "df", digits=4),
    query(S.CUSTOMERS, """SELECT round((m1 - m2) / sqrt(e1 + e2), 4) AS t, round(power(e1 + e2, 2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)), 4) AS df
FROM (SELECT avg(v) FILTER (WHERE b) AS m1, avg(v) FILTER (WHERE NOT b) AS m2, count(*) FILTER (WHERE b) AS n1, count(*) FILTER (WHERE NOT b) AS n2,
  var_samp(v) FILTER (WHERE b) / count(*) FILTER (WHERE b) AS e1, var_samp(v) FILTER (WHERE NOT b) / count(*) FILTER (WHERE NOT b) AS e2
 FROM (SELECT CAST(lifetime_value AS DOUBLE) AS v, customer_segment = 'B2B' AS b FROM dimc))"""))
add("ext11_anova_f", lambda s, f: _rounded(analysis.anova_f(Retail(s, f).orders, "shipping_method", "total_amount"), "f", digits=4),
    query(S.STAGED, """SELECT round((between_ / (k - 1)) / (within_ / (n - k)), 4) AS f, k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within
FROM (SELECT count(*) AS k, sum(c) AS n, sum(c * power(m - g, 2)) AS between_, sum((c - 1) * s) AS within_
 FROM (SELECT count(*) AS c, avg(CAST(total_amount AS DOUBLE)) AS m, var_samp(CAST(total_amount AS DOUBLE)) AS s,
   (SELECT avg(CAST(total_amount AS DOUBLE)) FROM s_ord) AS g FROM s_ord GROUP BY shipping_method))"""))
def _tail(a: str, b: str, x: str, source: str, columns: str) -> str:
    """SQL of the incomplete beta function by its continued fraction, step by step; a branch for each side."""
    return f"""
src AS ({source}),
arg AS (SELECT *, CAST({a} AS DOUBLE) AS a0, CAST({b} AS DOUBLE) AS b0, CAST({x} AS DOUBLE) AS x0 FROM src),
side AS (SELECT *, x0 >= (a0 + 1) / (a0 + b0 + 2) AS other FROM arg),
par AS (SELECT *, CASE WHEN other THEN b0 ELSE a0 END AS pa, CASE WHEN other THEN a0 ELSE b0 END AS pb, CASE WHEN other THEN 1 - x0 ELSE x0 END AS px FROM side),
steps AS (
 SELECT 0 AS m, pa, pb, px, CAST(1 AS DOUBLE) AS c, 1 / (1 - (pa + pb) * px / (pa + 1)) AS d, 1 / (1 - (pa + pb) * px / (pa + 1)) AS h FROM par
 UNION ALL SELECT m + 1, pa, pb, px, 1 + odd / c1, 1 / (1 + odd * d1), h * c1 * d1 * (1 + odd / c1) / (1 + odd * d1) FROM (
  SELECT *, 1 + even / c AS c1, 1 / (1 + even * d) AS d1, -(pa + k) * (pa + pb + k) * px / ((pa + 2 * k) * (pa + 2 * k + 1)) AS odd FROM (
   SELECT *, CAST(m + 1 AS DOUBLE) AS k, (m + 1) * (pb - m - 1) * px / ((pa + 2 * m + 1) * (pa + 2 * m + 2)) AS even FROM steps WHERE m < 600))),
done AS (SELECT h FROM steps WHERE m = 600)
SELECT {columns}, round(CASE WHEN other THEN 1 - g ELSE g END, 9) AS p_value
FROM (SELECT *, exp(pa * ln(px) + pb * ln(1 - px) - lgamma(pa) - lgamma(pb) + lgamma(pa + pb)) * h / pa AS g FROM par, done)"""


_WELCH = """SELECT (m1 - m2) / sqrt(e1 + e2) AS t, power(e1 + e2, 2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df
FROM (SELECT avg(v) FILTER (WHERE b) AS m1, avg(v) FILTER (WHERE NOT b) AS m2, count(*) FILTER (WHERE b) AS n1, count(*) FILTER (WHERE NOT b) AS n2,
  var_samp(v) FILTER (WHERE b) / count(*) FILTER (WHERE b) AS e1, var_samp(v) FILTER (WHERE NOT b) / count(*) FILTER (WHERE NOT b) AS e2
 FROM (SELECT CAST(lifetime_value AS DOUBLE) AS v, customer_segment = 'B2B' AS b FROM dimc))"""
_ANOVA = """SELECT (between_ / (k - 1)) / (within_ / (n - k)) AS f, k - 1 AS df_between, CAST(n - k AS BIGINT) AS df_within
FROM (SELECT count(*) AS k, sum(c) AS n, sum(c * power(m - g, 2)) AS between_, sum((c - 1) * s) AS within_
 FROM (SELECT count(*) AS c, avg(CAST(total_amount AS DOUBLE)) AS m, var_samp(CAST(total_amount AS DOUBLE)) AS s,
   (SELECT avg(CAST(total_amount AS DOUBLE)) FROM s_ord) AS g FROM s_ord GROUP BY shipping_method))"""


def _with_tail(parts: list[str], a: str, b: str, x: str, statistic: str, columns: str) -> str:
    return query(parts, "").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + _tail(a, b, x, statistic, columns)


add("ext11_welch_p", lambda s, f: _rounded(_rounded(analysis.welch_test(Retail(s, f).dim_customers, "customer_segment", "B2B", "B2C", "lifetime_value"), "t", "df", digits=4), "p_value", digits=9),
    _with_tail(S.CUSTOMERS, "df / 2", "0.5", "df / (df + t * t)", _WELCH, "round(t, 4) AS t, round(df, 4) AS df"))
add("ext11_anova_p", lambda s, f: _rounded(_rounded(analysis.anova_test(Retail(s, f).orders, "shipping_method", "total_amount"), "f", digits=4), "p_value", digits=9),
    _with_tail(S.STAGED, "df_within / 2", "df_between / 2", "df_within / (df_within + df_between * f)", _ANOVA, "round(f, 4) AS f, df_between, df_within"))


def _with_gaps(s, f):
    """Days of the daily sales without every fifth day and one month."""
    day = F.col("order_date")
    return _daily(s, f).filter((F.dayofmonth(day) % 5 != 0) & (F.date_format(day, "yyyy-MM") != "1996-05"))


def _mean_days(n: int) -> str:
    return quotient(f"(SELECT sum({cents('g.gross_revenue')}) FROM gaps g WHERE g.order_date BETWEEN x.order_date - {n - 1} AND x.order_date)",
                    f"least({n}, x.order_date - (SELECT min(order_date) FROM gaps) + 1) * 100", 2) + f" AS mean_{n}_days"


add("ext7_calendar_means", lambda s, f: analysis.calendar_means(_with_gaps(s, f)), query(_DAYS + ["""
gaps AS (SELECT * FROM daily WHERE day(order_date) % 5 <> 0 AND strftime(order_date, '%Y-%m') <> '1996-05')"""], f"""
SELECT order_date, gross_revenue, {_mean_days(7)}, {_mean_days(30)} FROM gaps x"""))
add("ext12_predicted_value", lambda s, f: analysis.predicted_value(Retail(s, f).ltv), query(S.CUSTOMERS + [S.LTV], """
SELECT customer_id, churn_status, CAST(CASE WHEN churn_status IN ('Churned', 'Never Purchased') THEN 0 ELSE round(projected_annual_value * 2, 2) END AS DECIMAL(18,2)) AS predicted_value FROM ltv"""))


def _score(s, f):
    c = F.col
    rows = dirty.raw(s, f, "customers")
    rules = [(c("customer_id").startswith("CUST-"), 40), (c("email").contains("@"), 30), (c("registration_date") != "not-a-date", 20), (c("phone") != "", 10)]
    return analysis.quality_score(rows, rules).select("customer_id", "zip_code", "dq_score")


add("ext3_quality_score", _score, f"""SELECT customer_id, zip_code, CAST(CASE WHEN starts_with(customer_id, 'CUST-') THEN 40 ELSE 0 END
 + CASE WHEN contains(email, '@') THEN 30 ELSE 0 END + CASE WHEN registration_date <> 'not-a-date' THEN 20 ELSE 0 END + CASE WHEN phone <> '' THEN 10 ELSE 0 END AS INT) AS dq_score
FROM ({dirty.RAW['customers']}) r""")


def _audited(s, f):
    return history.with_audit(dirty.raw(s, f, "products"), "batch-1", ["product_id", "sku"]).select("product_id", "_batch_id", "_file_row_hash", "_is_deleted")


add("ext1_audit_columns", _audited, f"""SELECT product_id, 'batch-1' AS _batch_id, sha256(product_id || chr(31) || sku) AS _file_row_hash, false AS _is_deleted
FROM ({dirty.RAW['products']}) r""")


def _newer(s, f):
    events = Retail(s, f).silver.raw("events").select("event_id", "ts")
    half = events.filter("ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'")
    return history.newer_rows(events, half, "ts", "event_id").select("event_id")


add("ext2_newer_rows", _newer, "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00')")


def _scd2(s, f):
    """Customers move state on odd keys; a fifth of the keys is new in the second snapshot."""
    customers = Retail(s, f).silver.customers.select("customer_id", "full_name", "state")
    number = F.substring("customer_id", 6, 9).cast("int")
    first = history.scd2_open(customers.filter(number % 5 != 0), ["full_name", "state"], F.lit("1995-01-01").cast("date"))
    moved = customers.withColumn("state", F.when(number % 2 == 1, F.lit("MOVED")).otherwise(F.col("state")))
    once = history.scd2_apply(first, moved, "customer_id", ["full_name", "state"], "2000-06-16")
    return history.scd2_apply(once, moved, "customer_id", ["full_name", "state"], "2001-01-01").drop("row_hash")


add("ext5_scd2", _scd2, query(S.SILVER + ["""
k AS (SELECT customer_id, full_name, state, CAST(substr(customer_id, 6, 9) AS INT) AS i FROM cust)"""], """
SELECT customer_id, full_name, state, DATE '1995-01-01' AS valid_from, CASE WHEN i % 2 = 1 THEN DATE '2000-06-15' END AS valid_to, i % 2 <> 1 AS is_current FROM k WHERE i % 5 <> 0
UNION ALL SELECT customer_id, full_name, CASE WHEN i % 2 = 1 THEN 'MOVED' ELSE state END, DATE '2000-06-16', NULL, true FROM k WHERE i % 5 = 0 OR i % 2 = 1"""))


def _lines_as_of(s, f):
    """Order lines with their customer's attributes of the day, over four snapshots, two of them of one day."""
    r = Retail(s, f)
    customers = r.silver.customers.select("customer_id", "customer_segment", "state")
    number, tracked = F.substring("customer_id", 6, 9).cast("int"), ["customer_segment", "state"]
    moved = customers.withColumn("state", F.when(number % 3 == 0, F.lit("MOVED")).otherwise(F.col("state")))
    versions = history.scd2_open(customers.filter(number % 5 != 0), tracked, F.lit("1992-06-01").cast("date"))
    versions = history.scd2_apply(versions, moved, "customer_id", tracked, "1994-06-30")
    for segment in ("WRONG", "KEY"):  # the second change of a day replaces the first
        changed = moved.withColumn("customer_segment", F.when(number % 2 == 0, F.lit(segment)).otherwise(F.col("customer_segment")))
        versions = history.scd2_apply(versions, changed, "customer_id", tracked, "1996-01-01")
    lines = r.lines.select("item_id", "customer_id", "order_date")
    return history.as_of_join(lines, versions, "customer_id", "order_date", {"customer_segment": "segment_then", "state": "state_then"})


add("ext5_lines_as_of", _lines_as_of, query(S.SALES + ["""
k AS (SELECT customer_id AS cid, customer_segment AS seg, state AS st, CAST(substr(customer_id, 6, 9) AS INT) AS i FROM cust)"""], """
SELECT item_id, customer_id, order_date,
 CASE WHEN order_date < DATE '1992-06-01' OR (i % 5 = 0 AND order_date < DATE '1994-06-30') THEN NULL
  WHEN order_date >= DATE '1996-01-01' AND i % 2 = 0 THEN 'KEY' ELSE seg END AS segment_then,
 CASE WHEN order_date < DATE '1992-06-01' OR (i % 5 = 0 AND order_date < DATE '1994-06-30') THEN NULL
  WHEN order_date >= DATE '1994-06-30' AND i % 3 = 0 THEN 'MOVED' ELSE st END AS state_then
FROM fact LEFT JOIN k ON customer_id = cid"""))
