"""Single operators of the inventory that no table or report shows on its own."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dirty
from checks import sql as S
from checks.layers import csv_folder, new_lake
from checks.retail import AS_OF, END, START, Retail
from checks.sql import query, total
from tallyhouse.functions import dates as D
from tallyhouse.operators import keys, publish, ranking
from tallyhouse.operators.ranking import Scale
from tallyhouse.operators.segments import segmented
from tallyhouse.plans import bronze, marketing, quality, refresh, reports, runs, silver
from tallyhouse.schemas import ENTITIES

QUERIES: dict = {}
SQL: dict[str, str] = {}
SILVER_TABLES = ("customers", "products", "orders", "order_items")


def add(name: str, build, text: str | None = None) -> None:
    QUERIES[name] = build
    if text is not None:
        SQL[name] = text


def _silver_lake(s, f, *tables: str):
    """The adapted tables published as silver."""
    lake, star = new_lake(s), Retail(s, f).silver
    for t in tables or SILVER_TABLES:
        publish.rebuild(lake, "silver", t, getattr(star, t))
    return lake


# --- sources and sinks ----------------------------------------------------------------------------

add("src4_layer_scan", lambda s, f: _silver_lake(s, f, "customers").read("silver", "customers").drop("_updated_at"),
    query(S.SILVER, "SELECT * FROM cust"))


def _key_scan(s, f) -> DataFrame:
    lake, files = new_lake(s), csv_folder(s, f, "events")
    bronze.load_bronze(lake, ENTITIES["events"], f"{files}/events.csv")
    return keys.known_keys(lake.read("bronze", "raw_events"), "event_id")


add("src5_key_scan", _key_scan, "SELECT DISTINCT 'EVT-' || CAST(event_id AS STRING) AS event_id FROM events")


def _views(s, f) -> DataFrame:
    runs.create_views(_silver_lake(s, f))
    return s.sql("""SELECT o.order_status, count(*) AS orders, sum(c.total_orders) AS orders_of_customers
        FROM stg_orders o JOIN int_customer_orders c USING (customer_id) GROUP BY o.order_status""")


add("src7_named_relations", _views, query(S.STAGED + [S.CUSTOMER_ORDERS], """SELECT order_status, count(*) AS orders,
 CAST(sum(total_orders) AS BIGINT) AS orders_of_customers FROM s_ord JOIN cust_ord USING (customer_id) GROUP BY 1"""))


def _run_log(s, f) -> DataFrame:
    lake, files = new_lake(s), csv_folder(s, f, "customers", "products")
    bronze.run_bronze(lake, files, ["customers", "products"])
    return lake.read("bronze", bronze.RUN_TABLE).select("pipeline_name", "status", "rows_processed", "error_message")


add("snk3_run_log", _run_log, """SELECT 'bronze_loader' AS pipeline_name, 'success' AS status,
 (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS rows_processed, CAST(NULL AS STRING) AS error_message""")


def _compacted(s, f) -> DataFrame:
    """A table written in many small files, then compacted."""
    lake, orders = new_lake(s), Retail(s, f).silver.orders.select("order_id", "customer_id", "total_amount")
    publish.rebuild(lake, "silver", "orders", orders.repartition(20, "order_id"))
    return publish.compact_files(lake, "silver", "orders")


add("ext12_compaction", _compacted, query(S.SILVER, "SELECT order_id, customer_id, total_amount FROM ord"))


def _export(s, f) -> DataFrame:
    """A report exported as CSV and read back as text."""
    path = csv_folder(s, f)
    publish.export_csv(reports.order_status(Retail(s, f).lines), path)
    return s.read.option("header", True).csv(path)


add("snk6_csv_export", _export, query(S.SALES, f"""SELECT order_status, CAST(count(DISTINCT order_id) AS STRING) AS orders,
 CAST({total('gross_revenue')} AS STRING) AS revenue FROM fact WHERE customer_segment IN ('B2C', 'B2B') GROUP BY 1"""))

# --- keys -----------------------------------------------------------------------------------------

_LATE = "order_date >= DATE'1999-01-01'"
add("jn1_with_parent", lambda s, f: keys.with_parent(Retail(s, f).items, Retail(s, f).orders.filter(_LATE), "order_id").select("item_id", "order_id"),
    query(S.STAGED, "SELECT item_id, order_id FROM s_item WHERE order_id IN (SELECT order_id FROM s_ord WHERE order_date >= DATE '1999-01-01')"))
add("jn6_orphans", lambda s, f: keys.orphans(Retail(s, f).items, Retail(s, f).orders.filter(_LATE), "order_id").select("item_id", "order_id"),
    query(S.STAGED, "SELECT item_id, order_id FROM s_item WHERE order_id NOT IN (SELECT order_id FROM s_ord WHERE order_date >= DATE '1999-01-01')"))
add("cln16_last_write_wins", lambda s, f: silver.last_written(dirty.bronze(s, f, "orders"), "orders").select("order_id", "shipping_method", "total_amount"),
    f"SELECT order_id, shipping_method, total_amount FROM {dirty._latest('orders', 'order_id')}")


def _silver_stats(s, f) -> DataFrame:
    """Two loads of the raw text through the silver run; counts per table."""
    lake = new_lake(s)
    for t in SILVER_TABLES:
        publish.append(lake, ENTITIES[t].bronze_table, dirty.bronze(s, f, t).drop("_load"))
    return silver.run_silver(lake)


_PAIRS = (("customers", "cust", "customer_id"), ("products", "prod", "product_id"), ("orders", "ord", "order_id"), ("order_items", "item", "item_id"))
add("pipe2_silver_run", _silver_stats, query(dirty.CLEANED, "SELECT *, candidates - written AS dropped FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT count(DISTINCT {k}) FROM ({dirty.RAW[t]}) r) AS candidates, (SELECT count(*) FROM {c}) AS written"
    for t, c, k in _PAIRS) + ")"))


def _gate(s, f) -> DataFrame:
    lake = _silver_lake(s, f)
    return quality.run_quality(lake, runs.staged(lake), quality.gate_checks("2010-01-01"))


add("pipe3_quality_gate", _gate, query(S.SILVER, """SELECT kind || '_' || "table" || '_' || "column" AS "check", "table", "column", failing_rows,
 CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
 SELECT 'unique' AS kind, 'customers' AS "table", 'customer_id' AS "column", (SELECT count(*) FROM (SELECT 1 FROM cust GROUP BY customer_id HAVING count(*) > 1)) AS failing_rows
 UNION ALL SELECT 'no_negative', 'orders', 'total_amount', (SELECT count(*) FROM ord WHERE total_amount < 0)
 UNION ALL SELECT 'no_future', 'orders', 'order_date', (SELECT count(*) FROM ord WHERE order_date > DATE '2010-01-01')
 UNION ALL SELECT 'relationships', 'orders', 'customer_id', (SELECT count(*) FROM ord WHERE customer_id NOT IN (SELECT customer_id FROM cust))
 UNION ALL SELECT 'relationships', 'order_items', 'product_id', (SELECT count(*) FROM item WHERE product_id NOT IN (SELECT product_id FROM prod)))"""))


def _gold(s, f) -> DataFrame:
    """Silver tables through the gold run; the published fact with its customer scores."""
    lake = _silver_lake(s, f)
    runs.run_gold(lake, START, END, AS_OF)
    return lake.read("gold", "fact_orders")


add("pipe4_gold_run", _gold, query(S.CUSTOMERS + [S.DATES, S.FACT], "SELECT * FROM fact"))



def _refreshed(s, f) -> DataFrame:
    """A gold run, then changed silver rows: late orders, two segments, costs of some products, lines; the refreshed fact."""
    lake, r = new_lake(s), Retail(s, f).silver
    then, now = (F.lit(f"2002-01-0{d} 00:00:00").cast("timestamp") for d in (1, 2))

    def put(table: str, rows: DataFrame, where=F.lit(False), **columns) -> None:
        new = {n: F.when(where, F.lit(v) if isinstance(v, str) else v).otherwise(F.col(n)).cast(rows.schema[n].dataType).alias(n) for n, v in columns.items()}
        publish.rebuild(lake, "silver", table, rows.withColumns({**new, "_updated_at": F.when(where, now).otherwise(then)}))

    for table in ("customers", "products", "orders", "order_items"):
        put(table, getattr(r, table))
    refresh.refresh_gold(lake, START, END, AS_OF)
    put("customers", r.customers, F.col("customer_id").isin("CUST-000000007", "CUST-000000011"), customer_segment="B2X")
    put("products", r.products, F.col("product_id").isin("PROD-000000005", "PROD-000000009"), cost_price=F.col("selling_price"))
    put("orders", r.orders, F.col("order_date").between("1997-03-01", "1997-03-10"), order_date=F.lit("1998-01-15").cast("date"))
    put("order_items", r.order_items, F.col("order_id").isin("ORD-000000001", "ORD-000000033"), quantity=F.lit(2))
    refresh.refresh_gold(lake, START, END, AS_OF)
    return lake.read("gold", "fact_orders")


_CHANGED = """
ord1 AS (SELECT * REPLACE (CASE WHEN order_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-10' THEN DATE '1998-01-15' ELSE order_date END AS order_date) FROM ord),
cust1 AS (SELECT * REPLACE (CASE WHEN customer_id IN ('CUST-000000007', 'CUST-000000011') THEN 'B2X' ELSE customer_segment END AS customer_segment) FROM cust),
prod1 AS (SELECT * REPLACE (CASE WHEN product_id IN ('PROD-000000005', 'PROD-000000009') THEN selling_price ELSE cost_price END AS cost_price) FROM prod),
item1 AS (SELECT * REPLACE (CASE WHEN order_id IN ('ORD-000000001', 'ORD-000000033') THEN CAST(2 AS INT) ELSE quantity END AS quantity) FROM item)"""


def _with_changes() -> str:
    """The fact's SQL over the changed relations in place of the silver ones."""
    base, *models = S.CUSTOMERS + [S.DATES, S.FACT]
    models = [re.sub(r"(FROM|JOIN) (ord|cust|prod|item)\b", r"\1 \g<2>1", m) for m in models]
    return query([base, _CHANGED, *models], "SELECT * FROM fact")


add("pipe4_refresh_gold", _refreshed, _with_changes())

# --- rankings and aggregates over whole tables -----------------------------------------------------


def _tiles(s, f) -> DataFrame:
    orders = Retail(s, f).orders.select("order_id", "total_amount", "ship_date")
    day = F.datediff("ship_date", F.lit("1970-01-01").cast("date"))
    tiles = ranking.ntile_columns(orders, "order_id", {
        "amount_tile": Scale(F.col("total_amount")), "ship_tile": Scale(day, descending=True, nulls_first=True)}, 7)
    return orders.select("order_id", *[c.alias(n) for n, c in tiles.items()])


add("win1_global_ntile", _tiles, query(S.STAGED, """SELECT order_id, CAST(ntile(7) OVER (ORDER BY total_amount, order_id) AS INT) AS amount_tile,
 CAST(ntile(7) OVER (ORDER BY ship_date DESC NULLS FIRST, order_id) AS INT) AS ship_tile FROM s_ord"""))
add("win1_global_row_number", lambda s, f: ranking.global_row_number(
    Retail(s, f).orders.select("order_id", "order_date"), [F.col("order_date").desc(), F.col("order_id")]),
    query(S.STAGED, "SELECT order_id, order_date, row_number() OVER (ORDER BY order_date DESC, order_id) AS row_number FROM s_ord"))
add("win2_segmented_scan", lambda s, f: segmented(
    Retail(s, f).silver.raw("orders").select("o_orderkey", "o_orderpriority", "o_orderdate", F.col("o_totalprice").cast("decimal(15,2)").alias("price")),
    {"o_orderdate": True, "o_orderkey": False}, "o_orderpriority", ties=1, rank="day_rank", percent="day_percent", row="place", tiles=("tenth", 10),
    running=("price", "upto")).withColumn("upto", F.col("upto").cast("decimal(28,2)")),
    """SELECT o_orderkey, o_orderpriority, o_orderdate, CAST(o_totalprice AS DECIMAL(15,2)) AS price, rank() OVER d AS day_rank, percent_rank() OVER d AS day_percent,
 row_number() OVER w AS place, CAST(ntile(10) OVER w AS INT) AS tenth, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS upto
FROM orders WINDOW d AS (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC), w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey)""")
add("win2_global_running_sum", lambda s, f: ranking.global_running_sum(
    Retail(s, f).orders.select("order_id", "total_amount"), [F.col("order_id")], "total_amount").withColumn(
        "running_sum", F.col("running_sum").cast("decimal(18,2)")),
    query(S.STAGED, """SELECT order_id, total_amount, CAST(sum(total_amount) OVER (ORDER BY order_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS running_sum FROM s_ord"""))
add("agg6_top_category", lambda s, f: marketing.top_category(Retail(s, f).lines), query(S.SALES, """SELECT order_date, category AS top_category FROM (
 SELECT order_date, category, row_number() OVER (PARTITION BY order_date ORDER BY count(*) DESC, category) AS place
 FROM fact WHERE is_completed GROUP BY order_date, category) WHERE place = 1"""))


def _months(s, f) -> DataFrame:
    r = Retail(s, f)
    both = r.orders.select("order_id", "customer_id", "order_date").join(r.customers.select("customer_id", "registration_date"), "customer_id")
    day, start = F.col("order_date"), F.col("registration_date")
    return both.select(
        "order_id", D.months_between_starts(day, start).alias("total_months"), D.months_between_starts(day, start, "as_written").alias("month_field"),
        F.datediff(day, start).alias("days"), D.month_label(day).alias("label"))


add("fn13_14_date_differences", _months, query(S.STAGED, """SELECT order_id, CAST(m AS INT) AS total_months, CAST(m % 12 AS INT) AS month_field,
 CAST(order_date - registration_date AS INT) AS days, strftime(order_date, '%Y-%m') AS label FROM (
 SELECT order_id, order_date, registration_date, (year(order_date) - year(registration_date)) * 12 + month(order_date) - month(registration_date) AS m
 FROM s_ord JOIN cust USING (customer_id))"""))
