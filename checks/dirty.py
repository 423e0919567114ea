"""Raw text tables with defects, derived from the test tables.

The expressions are SQL that Spark and DuckDB read alike, so both sides clean the same text. The text
carries every kind of defect the cleaning rules know: padded and mixed-case names, four date formats,
status synonyms, thousands separators, unusable numbers, unknown parents, repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql as S
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.star_adapter import RAW_SCHEMAS

_DAY = "CAST(o_orderdate AS DATE)"
_Y, _M, _D = (f"CAST({p}({_DAY}) AS STRING)" for p in ("year", "month", "day"))
_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)"

RAW = {
    "customers": """
SELECT CASE WHEN c_custkey % 211 = 3 THEN 'X' || CAST(c_custkey AS STRING) ELSE 'CUST-' || lpad(CAST(c_custkey AS STRING),9,'0') END AS customer_id,
 CASE c_custkey % 4 WHEN 0 THEN '  o''neil ' WHEN 1 THEN 'MARY-ann' WHEN 2 THEN 'jean  luc' ELSE 'x' || CAST(c_custkey AS STRING) || 'y' END AS first_name,
 CASE c_custkey % 3 WHEN 0 THEN 'mc-donald' WHEN 1 THEN ' SMITH' ELSE 'd''arcy2b' END AS last_name,
 CASE c_custkey % 5 WHEN 0 THEN ' User' || CAST(c_custkey AS STRING) || '@Example.COM ' WHEN 1 THEN 'not-an-email' WHEN 2 THEN ''
  WHEN 3 THEN 'missing@' ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.example.org' END AS email,
 '555-' || CAST(c_custkey AS STRING) AS phone, 'City ' || CAST(c_nationkey AS STRING) AS city,
 CASE WHEN c_custkey % 2 = 0 THEN ' st' || CAST(c_nationkey AS STRING) ELSE 'ST' || CAST(c_nationkey AS STRING) || ' ' END AS state,
 ' usa' AS country, lpad(CAST(c_custkey AS STRING), 5, '0') AS zip_code,
 CASE c_custkey % 3 WHEN 0 THEN 'b2b' WHEN 1 THEN ' B2C ' ELSE 'B2c' END AS customer_segment,
 CASE WHEN c_custkey % 101 = 0 THEN 'not-a-date' ELSE '199' || CAST(5 + c_custkey % 2 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING),2,'0') || '-15' END AS registration_date,
 c_custkey AS _row_id, 1 AS _load FROM customer""",
    "products": """
SELECT 'PROD-' || lpad(CAST(p_partkey AS STRING),9,'0') AS product_id, '  ' || p_name || ' ' AS product_name,
 CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE ' ' || p_type || '''S & co' END AS category,
 split_part(p_name,' ',2) AS subcategory, ' ' || p_brand AS brand,
 CASE p_partkey % 10 WHEN 0 THEN '1_0.5' WHEN 1 THEN 'nan' WHEN 2 THEN '-5' WHEN 3 THEN '99999.99' ELSE CAST(CAST(p_retailprice / 2 AS DECIMAL(10,2)) AS STRING) END AS cost_price,
 CASE WHEN p_partkey % 37 = 0 THEN '0' WHEN p_partkey % 41 = 0 THEN '1.5d' ELSE '1,' || lpad(CAST(p_partkey % 1000 AS STRING),3,'0') || '.995' END AS selling_price,
 CASE p_partkey % 4 WHEN 0 THEN '12.9' WHEN 1 THEN '' WHEN 2 THEN '1,000' ELSE CAST(p_partkey % 60 AS STRING) END AS stock_quantity,
 'SKU-' || CAST(p_partkey AS STRING) AS sku, p_partkey AS _row_id, 1 AS _load FROM part""",
    "orders": f"""
SELECT 'ORD-' || lpad(CAST(o_orderkey AS STRING),9,'0') AS order_id,
 CASE WHEN o_orderkey % 53 = 0 THEN 'CUST-999999999' ELSE 'CUST-' || lpad(CAST(o_custkey AS STRING),9,'0') END AS customer_id,
 CASE WHEN o_orderkey % 97 = 0 THEN 'soon' WHEN o_orderkey % 89 = 0 THEN '2023-02-30' ELSE
  CASE o_orderkey % 5 WHEN 0 THEN {_Y} || '-' || lpad({_M},2,'0') || '-' || lpad({_D},2,'0') WHEN 1 THEN lpad({_M},2,'0') || '/' || lpad({_D},2,'0') || '/' || {_Y}
   WHEN 2 THEN lpad({_D},2,'0') || '-' || lpad({_M},2,'0') || '-' || {_Y} WHEN 3 THEN {_Y} || '/' || {_M} || '/' || {_D} ELSE ' ' || {_Y} || '-' || {_M} || '-' || {_D} || ' ' END END AS order_date,
 CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE {_Y} || '-12-31' END AS ship_date, o_orderpriority AS shipping_method,
 CASE o_orderkey % 11 WHEN 0 THEN 'Complete' WHEN 1 THEN 'DONE' WHEN 2 THEN ' shipped' WHEN 3 THEN 'in_transit' WHEN 4 THEN 'processing' WHEN 5 THEN 'Pending '
  WHEN 6 THEN 'cancel' WHEN 7 THEN 'CANCELED' WHEN 8 THEN 'return' WHEN 9 THEN 'completed' ELSE 'returned' END AS order_status,
 CASE WHEN o_orderkey % 71 = 0 THEN '-' || {_AMOUNT} WHEN o_orderkey % 73 = 0 THEN 'n/a' WHEN o_totalprice >= 1000 AND o_orderkey % 2 = 0
  THEN substr({_AMOUNT}, 1, length({_AMOUNT}) - 6) || ',' || substr({_AMOUNT}, length({_AMOUNT}) - 5, 6) ELSE {_AMOUNT} END AS total_amount,
 CASE o_orderkey % 5 WHEN 0 THEN ' SAVE10 ' WHEN 1 THEN '' ELSE 'VIP25' END AS discount_code, o_orderkey AS _row_id, 1 AS _load FROM orders""",
    "order_items": """
SELECT 'ITEM-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS item_id,
 CASE WHEN l_suppkey % 47 = 5 THEN 'ORD-x' ELSE 'ORD-' || lpad(CAST(l_orderkey AS STRING),9,'0') END AS order_id,
 'PROD-' || lpad(CAST(l_partkey AS STRING),9,'0') AS product_id,
 CASE l_linenumber % 7 WHEN 0 THEN '0' WHEN 1 THEN '2.9' WHEN 2 THEN 'x' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
 CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS unit_price,
 CASE l_linenumber % 6 WHEN 0 THEN '150' WHEN 1 THEN '-5' WHEN 2 THEN 'nan' ELSE CAST(CAST(l_discount * 100 AS INT) AS STRING) END AS discount_pct,
 CAST(l_orderkey AS BIGINT) AS _row_id, 1 AS _load FROM lineitem""",
    "events": """
SELECT 'EVT-' || CAST(event_id AS STRING) AS event_id, 'CUST-' || lpad(CAST(user_id AS STRING),9,'0') AS customer_id,
 CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type, '' AS product_id,
 '2024-01-01 00:00:00' AS event_timestamp, 'SESS-' || CAST(user_id AS STRING) AS session_id, 'desktop' AS device_type, event_id AS _row_id, 1 AS _load FROM events""",
}

# A second load repeats every key with a changed value: the later load must win.
SECOND = {
    "customers": ("phone", "'changed'"),
    "products": ("sku", "'changed'"),
    "orders": ("shipping_method", "'changed'"),
    "order_items": ("unit_price", "'12.345'"),
}


def with_second_load(entity: str) -> str:
    """Two loads of the same rows, the second with one column changed."""
    column, value = SECOND[entity]
    first = RAW[entity].strip()
    again = ", ".join(f"{value} AS {c}" if c == column else c for c in ENTITIES[entity].columns)
    return f"SELECT * FROM ({first}) a UNION ALL SELECT {again}, _row_id, 2 AS _load FROM ({first}) b"


def frame(spark: SparkSession, folder: str, text: str) -> DataFrame:
    for name, schema in RAW_SCHEMAS.items():
        spark.read.schema(schema).parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(text)


def bronze(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """Bronze rows of an entity in two loads."""
    return frame(spark, folder, with_second_load(entity)).withColumn(
        "_ingested_at", F.make_timestamp(F.lit(2024), F.lit(1), F.col("_load"), F.lit(0), F.lit(0), F.lit(0)))


def raw(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The text columns of one load, as the CSV file holds them."""
    return frame(spark, folder, RAW[entity]).drop("_row_id", "_load")


# --- the same cleaning in DuckDB ------------------------------------------------------------------

_TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_NUMERIC = r"'^[+-]?[0-9][0-9_]*(\.[0-9]*)?$'"


def _trim(x: str) -> str:
    return _TRIM.format(x)


def _number(x: str) -> str:
    t = _trim(f"replace({x}, ',', '')")
    return f"CASE WHEN regexp_matches({t}, {_NUMERIC}) THEN TRY_CAST(replace({t}, '_', '') AS DECIMAL(20,6)) END"


def _title(x: str) -> str:
    """Letters after a non-letter upper-cased, by splitting into letter runs."""
    return (f"list_aggregate(list_transform(regexp_extract_all(lower({_trim(x)}), '[a-z]+|[^a-z]+'), "
            f"lambda w: upper(w[1]) || w[2:]), 'string_agg', '')")


def _date(x: str) -> str:
    t = _trim(x)
    tests = (("^\\d{4}-\\d{1,2}-\\d{1,2}$", "%Y-%m-%d"), ("^\\d{1,2}/\\d{1,2}/\\d{4}$", "%m/%d/%Y"),
             ("^\\d{1,2}-\\d{1,2}-\\d{4}$", "%d-%m-%Y"), ("^\\d{4}/\\d{1,2}/\\d{1,2}$", "%Y/%m/%d"))
    return "CASE " + " ".join(
        f"WHEN regexp_matches({t}, '{p}') THEN CAST(try_strptime({t}, '{f}') AS DATE)" for p, f in tests) + " END"


def _latest(entity: str, key: str) -> str:
    return (f"(SELECT * FROM ({with_second_load(entity)}) z "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY _load DESC, _row_id DESC) = 1)")


CLEAN_CUSTOMERS = f"""
cust AS (
 SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, phone, city, state, country, zip_code, customer_segment, registration_date
 FROM (SELECT customer_id, {_title('first_name')} AS first_name, {_title('last_name')} AS last_name,
   CASE WHEN regexp_matches(lower({_trim('email')}), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN lower({_trim('email')}) END AS email, phone, city,
   upper({_trim('state')}) AS state, upper({_trim('country')}) AS country, zip_code, upper({_trim('customer_segment')}) AS customer_segment,
   {_date('registration_date')} AS registration_date FROM {_latest('customers', 'customer_id')} WHERE starts_with(customer_id, 'CUST-')))"""

CLEAN_PRODUCTS = f"""
prod AS (
 SELECT *, CASE WHEN selling_price > 0 THEN {S.quotient('(' + S.cents('selling_price') + ' - ' + S.cents('cost_price') + ') * 100', S.cents('selling_price'), 2, 5)} ELSE 0 END AS margin_pct
 FROM (SELECT product_id, {_trim('product_name')} AS product_name, {_title('category')} AS category, subcategory, {_trim('brand')} AS brand,
   CAST(round(coalesce({_number('cost_price')}, 0), 2) AS DECIMAL(10,2)) AS cost_price, CAST(round(coalesce({_number('selling_price')}, 0), 2) AS DECIMAL(10,2)) AS selling_price,
   CAST(trunc(coalesce({_number('stock_quantity')}, 0)) AS INT) AS stock_quantity, sku FROM {_latest('products', 'product_id')})
 WHERE selling_price > 0 AND cost_price >= 0 AND cost_price <= selling_price)"""

CLEAN_ORDERS = f"""
ord AS (
 SELECT order_id, customer_id, order_date, ship_date, CAST(ship_date - order_date AS INT) AS days_to_ship, shipping_method, order_status, total_amount, discount_code
 FROM (SELECT order_id, customer_id, {_date('order_date')} AS order_date, {_date('ship_date')} AS ship_date, shipping_method,
   CASE lower({_trim('order_status')}) WHEN 'complete' THEN 'completed' WHEN 'done' THEN 'completed' WHEN 'in_transit' THEN 'shipped' WHEN 'pending' THEN 'processing'
    WHEN 'cancel' THEN 'cancelled' WHEN 'canceled' THEN 'cancelled' WHEN 'return' THEN 'returned' ELSE lower({_trim('order_status')}) END AS order_status,
   CAST(round(coalesce({_number('total_amount')}, 0), 2) AS DECIMAL(12,2)) AS total_amount, discount_code FROM {_latest('orders', 'order_id')})
 WHERE order_date IS NOT NULL AND total_amount >= 0 AND customer_id IN (SELECT customer_id FROM cust))"""

CLEAN_ITEMS = f"""
item AS (
 SELECT *, {S.quotient(f"quantity * {S.cents('unit_price')} * (10000 - {S.cents('discount_pct')})", '1000000', 2, 12)} AS line_total
 FROM (SELECT item_id, order_id, product_id, CAST(greatest(1, trunc(coalesce({_number('quantity')}, 1))) AS INT) AS quantity,
   CAST(round(coalesce({_number('unit_price')}, 0), 2) AS DECIMAL(10,2)) AS unit_price,
   CAST(least(100, greatest(0, coalesce({_number('discount_pct')}, 0))) AS DECIMAL(5,2)) AS discount_pct FROM {_latest('order_items', 'item_id')})
 WHERE order_id IN (SELECT order_id FROM ord) AND product_id IN (SELECT product_id FROM prod))"""

CLEANED = [CLEAN_CUSTOMERS, CLEAN_PRODUCTS, CLEAN_ORDERS, CLEAN_ITEMS]
