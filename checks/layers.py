"""Sources, bronze, silver, quality and whole runs over text derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import dirty
from checks import sql as S
from checks.gold import _DAILY
from checks.retail import AS_OF, END, START, Retail
from checks.sql import query
from tallyhouse.functions import parse, text
from tallyhouse.functions.sql_names import register
from tallyhouse.operators import keys, scratch
from tallyhouse.operators.publish import export_csv, rebuild, upsert
from tallyhouse.plans import bronze, quality, runs, silver
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.csv_files import scan_csv
from tallyhouse.sources.sql import run_sql
from tallyhouse.sources.tables import Lake

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql is not None:
        SQL[name] = sql


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch.new_path(spark, "lake"))


def raw_sql(entity: str) -> str:
    return f"SELECT {', '.join(ENTITIES[entity].columns)} FROM ({dirty.RAW[entity]}) r"


def csv_folder(spark: SparkSession, folder: str, *entities: str) -> str:
    """The dirty text of each entity as CSV files."""
    out = scratch.new_path(spark, "csv")
    for e in entities:
        export_csv(dirty.raw(spark, folder, e), f"{out}/{ENTITIES[e].file}")
    return out


# --- sources and sinks ----------------------------------------------------------------------------


def _scan(spark, folder) -> DataFrame:
    files = csv_folder(spark, folder, "products")
    return scan_csv(spark, ENTITIES["products"], f"{files}/products.csv").select(*ENTITIES["products"].columns)


add("src1_csv_scan", _scan, raw_sql("products"))


# Lines of a product file: every seventh row has two cells too many, every eleventh ends after three, and quoted cells
# hold commas and quotes. Spark and DuckDB read the expressions alike.
_NAME = "'\"' || replace(p_name, ' ', ', ') || ' \"\"x\"\"\"'"
_LINE = f"""CASE WHEN p_partkey % 7 = 0 THEN 'P' || CAST(p_partkey AS STRING) || ',' || {_NAME} || ',c,s,b,1,2,3,sku,more,cells'
 WHEN p_partkey % 11 = 0 THEN 'P' || CAST(p_partkey AS STRING) || ',' || {_NAME} || ',c'
 ELSE 'P' || CAST(p_partkey AS STRING) || ',' || {_NAME} || ',c,,b,1,2,3,"' || p_brand || '"' END"""


def _uneven_files(spark, folder) -> str:
    """Product lines in four files, each with its header."""
    out, header = scratch.new_path(spark, "uneven"), ",".join(ENTITIES["products"].columns)
    lines = spark.read.parquet(f"{folder}/part.parquet").selectExpr("CAST(p_partkey % 4 AS STRING) AS b", "p_partkey AS at", f"{_LINE} AS value")
    heads = spark.range(4).selectExpr("CAST(id AS STRING) AS b", "CAST(-1 AS BIGINT) AS at", f"'{header}' AS value")
    rows = lines.unionByName(heads).repartition(4, "b").sortWithinPartitions("b", "at")
    rows.select("b", "value").write.partitionBy("b").text(out)
    return f"{out}/b=*"


def _malformed_rows(spark, folder) -> DataFrame:
    """Files with malformed rows loaded twice: good rows in bronze, the others whole, each once."""
    lake, path = new_lake(spark), _uneven_files(spark, folder)
    for _ in range(2):
        bronze.load_bronze(lake, ENTITIES["products"], path)
    good = lake.read("bronze", "raw_products").select(F.lit("products").alias("table"), F.col("product_id").alias("key"), "product_name", "sku", F.lit(None).cast("string").alias("record"))
    bad = lake.read("bronze", bronze.MALFORMED_TABLE).select("table", "key", *[F.lit(None).cast("string").alias(c) for c in ("product_name", "sku")], "record")
    return good.unionByName(bad)


add("src1_malformed_rows", _malformed_rows, f"""SELECT 'products' AS "table", 'P' || CAST(p_partkey AS STRING) AS key,
 CASE WHEN ok THEN replace(p_name, ' ', ', ') || ' "x"' END AS product_name, CASE WHEN ok THEN p_brand END AS sku,
 CASE WHEN NOT ok THEN {_LINE} END AS record FROM (SELECT *, p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AS ok FROM part) p""")


def _malformed_counts(spark, folder) -> DataFrame:
    """Counts of two loads, of a load that allows no malformed row, and what the run log says."""
    lake, path = new_lake(spark), _uneven_files(spark, folder)
    loads = [bronze.load_bronze(lake, ENTITIES["products"], path, max_malformed=limit) for limit in (0, None, None)]
    stored = lake.read("bronze", bronze.MALFORMED_TABLE).count()
    return spark.createDataFrame(
        [(i, r.status, r.rows_processed, r.rows_skipped, r.rows_malformed, stored) for i, r in enumerate(loads)],
        "load long, status string, rows_processed long, rows_skipped long, rows_malformed long, stored long")


add("snk7_malformed_counts", _malformed_counts, """WITH n AS (SELECT count(*) FILTER (p_partkey % 7 = 0 OR p_partkey % 11 = 0) AS bad,
 count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 11 <> 0) AS good FROM part)
SELECT CAST(0 AS BIGINT) AS load, 'failed' AS status, CAST(0 AS BIGINT) AS rows_processed, CAST(0 AS BIGINT) AS rows_skipped, bad AS rows_malformed, bad AS stored FROM n
UNION ALL SELECT 1, 'success', good, 0, bad, bad FROM n UNION ALL SELECT 2, 'success', 0, good, bad, bad FROM n""")


def _load_twice(spark, folder) -> DataFrame:
    """Two loads of one file: the second finds every key already there."""
    lake, files = new_lake(spark), csv_folder(spark, folder, "orders")
    first = bronze.load_bronze(lake, ENTITIES["orders"], f"{files}/orders.csv")
    second = bronze.load_bronze(lake, ENTITIES["orders"], f"{files}/orders.csv")
    rows = lake.read("bronze", "raw_orders").agg(F.count(F.lit(1)).alias("bronze_rows"))
    return rows.select("bronze_rows", *[F.lit(v).cast("long").alias(n) for n, v in (
        ("first_new", first.rows_processed), ("first_skipped", first.rows_skipped),
        ("second_new", second.rows_processed), ("second_skipped", second.rows_skipped))])


add("snk7_load_stats", _load_twice, """SELECT count(*) AS bronze_rows, count(*) AS first_new, CAST(0 AS BIGINT) AS first_skipped,
 CAST(0 AS BIGINT) AS second_new, count(*) AS second_skipped FROM orders""")


def _append_all(spark, folder) -> DataFrame:
    lake, files = new_lake(spark), csv_folder(spark, folder, "customers")
    for _ in range(2):
        bronze.load_bronze(lake, ENTITIES["customers"], f"{files}/customers.csv", mode="append_all")
    return lake.read("bronze", "raw_customers").select(*ENTITIES["customers"].columns)


add("snk1_bronze_append_all", _append_all, f"{raw_sql('customers')} UNION ALL {raw_sql('customers')}")


def _run_log(spark, folder) -> DataFrame:
    """A bronze run with one file missing: the others load, the run is logged as failed."""
    lake, files = new_lake(spark), csv_folder(spark, folder, "customers", "orders")
    result = bronze.run_bronze(lake, files, ["customers", "products", "orders"], strict=False)
    logged = lake.read("bronze", bronze.RUN_TABLE).first()
    return result.select("entity", "status", "rows_processed", "rows_skipped",
                         F.lit(logged["status"]).alias("run_status"), F.lit(logged["rows_processed"]).alias("run_rows"))


add("pipe1_bronze_run", _run_log, """SELECT t.*, 'failed' AS run_status, (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS run_rows FROM (
 SELECT 'customers' AS entity, 'success' AS status, count(*) AS rows_processed, CAST(0 AS BIGINT) AS rows_skipped FROM customer
 UNION ALL SELECT 'products', 'failed', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
 UNION ALL SELECT 'orders', 'success', count(*), CAST(0 AS BIGINT) FROM orders) t""")


def _skip_known(spark, folder) -> DataFrame:
    orders = Retail(spark, folder).silver.orders
    known = orders.filter(F.col("order_date") < "1998-01-01")
    return keys.without_known(orders, known, "order_id").select("order_id", "order_date")


add("jn2_skip_known_keys", _skip_known, query(S.SILVER, "SELECT order_id, order_date FROM ord WHERE order_date >= DATE '1998-01-01'"))


def _upsert(spark, folder) -> DataFrame:
    """Orders before 1999 are the target; those from 1997 on come again with another amount."""
    lake = new_lake(spark)
    orders = Retail(spark, folder).silver.orders.select("order_id", "order_date", "total_amount")
    rebuild(lake, "silver", "orders", orders.filter(F.col("order_date") < "1999-01-01"))
    again = orders.filter(F.col("order_date") >= "1997-01-01").withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(12,2)"))
    return upsert(lake, "silver", "orders", again, "order_id")


add("snk2_keyed_upsert", _upsert, query(S.SILVER, """SELECT order_id, order_date,
 CAST(CASE WHEN order_date >= DATE '1997-01-01' THEN total_amount + 1 ELSE total_amount END AS DECIMAL(12,2)) AS total_amount FROM ord"""))


def _bound_sql(spark, folder) -> DataFrame:
    r = Retail(spark, folder)
    return run_sql(spark, """SELECT order_status, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount
        FROM {orders} WHERE order_year = :year AND shipping_method <> :method GROUP BY order_status""",
                   {"year": 1997, "method": "5-LOW"}, orders=r.orders)


add("src8_parameterised_sql", _bound_sql, query(S.STAGED, f"""SELECT order_status, count(*) AS orders, {S.total('total_amount')} AS amount
FROM s_ord WHERE order_year = 1997 AND shipping_method <> '5-LOW' GROUP BY 1"""))


# --- cleaning -------------------------------------------------------------------------------------


def _parents(spark, folder):
    customers = silver.clean_customers(silver.last_written(dirty.bronze(spark, folder, "customers"), "customers"))
    products = silver.clean_products(silver.last_written(dirty.bronze(spark, folder, "products"), "products"))
    orders = silver.clean_orders(silver.last_written(dirty.bronze(spark, folder, "orders"), "orders"), customers)
    return customers, products, orders


add("slv1_clean_customers", lambda s, f: _parents(s, f)[0].drop("_updated_at"), query([dirty.CLEAN_CUSTOMERS], "SELECT * FROM cust"))
add("slv2_clean_products", lambda s, f: _parents(s, f)[1].drop("_updated_at"), query([dirty.CLEAN_PRODUCTS], "SELECT * FROM prod"))
add("slv3_clean_orders", lambda s, f: _parents(s, f)[2].drop("_updated_at"), query(dirty.CLEANED[:1] + dirty.CLEANED[2:3], "SELECT * FROM ord"))


def _clean_items(spark, folder) -> DataFrame:
    _, products, orders = _parents(spark, folder)
    rows = silver.last_written(dirty.bronze(spark, folder, "order_items"), "order_items")
    return silver.clean_order_items(rows, orders, products).drop("_updated_at")


add("slv4_clean_order_items", _clean_items, query(dirty.CLEANED, "SELECT * FROM item"))


def _sql_functions(spark, folder) -> DataFrame:
    """The cleaning rules under their SQL names."""
    register(spark)
    dirty.raw(spark, folder, "orders").createOrReplaceTempView("raw_orders_text")
    return spark.sql("""SELECT order_id, clean_date(order_date) AS order_date, standardize_status(order_status) AS order_status,
        CAST(clean_numeric(total_amount) AS DECIMAL(12,2)) AS total_amount FROM raw_orders_text""")


add("cln_sql_functions", _sql_functions, f"""SELECT order_id, {dirty._date('order_date')} AS order_date,
 CASE lower({dirty._trim('order_status')}) WHEN 'complete' THEN 'completed' WHEN 'done' THEN 'completed' WHEN 'in_transit' THEN 'shipped'
  WHEN 'pending' THEN 'processing' WHEN 'cancel' THEN 'cancelled' WHEN 'canceled' THEN 'cancelled' WHEN 'return' THEN 'returned'
  ELSE lower({dirty._trim('order_status')}) END AS order_status,
 CAST(coalesce({dirty._number('total_amount')}, 0) AS DECIMAL(12,2)) AS total_amount FROM ({dirty.RAW['orders']}) r""")


def _scalars(spark, folder) -> DataFrame:
    """Each scalar rule on its own over the raw text."""
    c = F.col
    return dirty.raw(spark, folder, "order_items").select(
        "item_id", parse.clean_quantity(c("quantity")).alias("quantity"), parse.clean_percent(c("discount_pct")).alias("discount_pct"),
        parse.clean_money(c("unit_price")).alias("unit_price"), parse.clean_int(c("quantity"), 7).alias("whole"),
        text.blank_to_null(c("discount_pct")).alias("text"))


add("cln9_11_scalar_rules", _scalars, f"""SELECT item_id, CAST(greatest(1, trunc(coalesce({dirty._number('quantity')}, 1))) AS INT) AS quantity,
 CAST(least(100, greatest(0, coalesce({dirty._number('discount_pct')}, 0))) AS DECIMAL(5,2)) AS discount_pct,
 CAST(round(coalesce({dirty._number('unit_price')}, 0), 2) AS DECIMAL(12,2)) AS unit_price,
 CAST(trunc(coalesce({dirty._number('quantity')}, 7)) AS INT) AS whole, nullif(trim(discount_pct), '') AS text FROM ({dirty.RAW['order_items']}) r""")

# --- quality --------------------------------------------------------------------------------------


def _quality(spark, folder) -> DataFrame:
    """All checks over text tables that were typed but not filtered, so that checks fail."""
    r = Retail(spark, folder)
    tables = {"customers": r.customers.filter(F.col("country") != "ASIA"), "products": r.products.filter(F.col("stock_quantity") > 5),
              "orders": r.orders.withColumn("order_status", F.when(F.col("order_status") != "returned", F.col("order_status")).otherwise("sent back")),
              "order_items": r.items.unionByName(r.items.filter(F.col("quantity") > 40))}
    checks = quality.table_checks() + quality.gate_checks("2000-06-30")[1:3] + quality.length_checks()
    return quality.report(tables, checks)


_BROKEN = """
q_customers AS (SELECT * FROM cust WHERE country <> 'ASIA'), q_products AS (SELECT * FROM s_prod WHERE stock_quantity > 5),
q_orders AS (SELECT * REPLACE (CASE WHEN order_status = 'returned' THEN 'sent back' ELSE order_status END AS order_status) FROM s_ord),
q_order_items AS (SELECT * FROM s_item UNION ALL SELECT * FROM s_item WHERE quantity > 40)"""


def _quality_sql() -> str:
    rows = []

    def one(kind, table, column, counted):
        rows.append(f"SELECT '{kind}_{table}_{column}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", ({counted}) AS failing_rows")

    def where(kind, table, column, cond):
        one(kind, table, column, f"SELECT count(*) FROM q_{table} WHERE {cond}")

    for table, columns in {"customers": ("customer_id", "registration_date"), "orders": ("order_id", "customer_id", "total_amount", "order_date"),
                           "products": ("product_id", "category", "selling_price"),
                           "order_items": ("item_id", "order_id", "product_id", "quantity", "unit_price")}.items():
        one("unique", table, columns[0], f"SELECT count(*) FROM (SELECT {columns[0]} FROM q_{table} WHERE {columns[0]} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c in columns:
            where("not_null", table, c, f"{c} IS NULL")
    where("accepted_values", "customers", "customer_segment", "customer_segment NOT IN ('B2B','B2C')")
    where("accepted_values", "orders", "order_status", "order_status NOT IN ('completed','shipped','processing','cancelled','returned')")
    for table, column, parent in (("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"), ("order_items", "product_id", "products")):
        where("relationships", table, column, f"{column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM q_{parent})")
    where("no_negative", "orders", "total_amount", "total_amount < 0")
    where("no_future", "orders", "order_date", "order_date > DATE '2000-06-30'")
    where("max_length", "customers", "customer_segment", "length(customer_segment) > 10")
    where("max_length", "orders", "order_status", "length(order_status) > 30")
    return ("SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + "\nUNION ALL ".join(rows) + ")")


add("dq_report", _quality, query(S.STAGED + [_BROKEN], _quality_sql()))


def _failing_rows(spark, folder) -> DataFrame:
    """Gate over broken tables: it raises, and the failing rows are stored."""
    lake, r = new_lake(spark), Retail(spark, folder)
    tables = {"customers": r.customers.filter(F.col("country") != "ASIA"), "orders": r.orders}
    checks = [quality.refers_to("orders", "customer_id", "customers"), quality.unique("customers", "customer_id")]
    try:
        quality.run_quality(lake, tables, checks)
    except quality.QualityError:
        pass
    return lake.read("dq_failures", checks[0].name).select("order_id", "customer_id")


add("snk5_stored_failures", _failing_rows, query(S.STAGED, """SELECT order_id, customer_id FROM s_ord
WHERE customer_id NOT IN (SELECT customer_id FROM cust WHERE country <> 'ASIA')"""))

# --- whole runs -----------------------------------------------------------------------------------


def _full_run(spark, folder) -> DataFrame:
    """CSV files through all layers; returns the published daily sales."""
    lake = new_lake(spark)
    files = csv_folder(spark, folder, *ENTITIES)
    runs.run_bronze(lake, files)
    runs.run_silver(lake)
    s = runs.staged(lake)
    quality.run_quality(lake, s, quality.gate_checks("2024-01-01"))
    runs.run_gold(lake, START, END, AS_OF)
    return lake.read("gold", "daily_sales")


_ONE_LOAD = [c.replace(dirty.with_second_load(e), dirty.RAW[e]) for c, e in zip(dirty.CLEANED, ("customers", "products", "orders", "order_items"))]
add("pipe5_full_run", _full_run, query(_ONE_LOAD + [S.STAGING, S.DATES, S.LINES, _DAILY], "SELECT * FROM daily"))
