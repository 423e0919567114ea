"""Cases that simpler forms of the operators would lose or cut: oversize numbers, fine decimals, late and unnamed rows."""

from __future__ import annotations

import datetime as dt
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dirty
from checks import sql as S
from checks.gold import _DAILY
from checks.layers import csv_folder, new_lake
from checks.retail import AS_OF, END, START, Retail
from checks.sql import query, total
from checks.streams import _checkpoint, _EVENTS, _stored_events
from tallyhouse.functions import parse
from tallyhouse.operators import history, keys, publish, ranking, scratch
from tallyhouse.operators.changes import compact, compact_sums, current_rows, sum_of_changes
from tallyhouse.operators.ranking import Scale
from tallyhouse.plans import analysis, bronze, reports, runs, silver
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.csv_files import scan_csv
from tallyhouse.streaming import daily, events, ingest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, build, sql: str) -> None:
    QUERIES[name], SQL[name] = build, sql


# --- numbers that do not fit ------------------------------------------------------------------------

_BIG = """SELECT p_partkey,
 CASE p_partkey % 6 WHEN 0 THEN '123456789.50' WHEN 1 THEN '99999999999.00' WHEN 2 THEN '1e30' WHEN 3 THEN 'x' WHEN 4 THEN '-1e25'
  ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END AS value FROM part"""


def _oversize(s, f) -> DataFrame:
    v = F.col("value")
    return dirty.frame(s, f, _BIG).select(
        "p_partkey", parse.clean_money(v).alias("amount"), parse.clean_money(v, silver.PRICE).alias("price"), parse.clean_int(v).alias("whole"),
        parse.clean_quantity(v).alias("quantity"), parse.clean_percent(v).alias("percent"))


add("cln_oversize_values", _oversize, f"""SELECT p_partkey,
 CASE p_partkey % 6 WHEN 0 THEN 123456789.50 WHEN 3 THEN 0 WHEN 5 THEN CAST(value AS DECIMAL(12,2)) END::DECIMAL(12,2) AS amount,
 CASE p_partkey % 6 WHEN 3 THEN 0 WHEN 5 THEN CAST(value AS DECIMAL(10,2)) END::DECIMAL(10,2) AS price,
 CASE p_partkey % 6 WHEN 0 THEN 123456789 WHEN 3 THEN 0 WHEN 5 THEN CAST(floor(CAST(value AS DECIMAL(10,2))) AS INT) END::INT AS whole,
 CASE p_partkey % 6 WHEN 0 THEN 123456789 WHEN 3 THEN 1 WHEN 5 THEN CAST(floor(CAST(value AS DECIMAL(10,2))) AS INT) END::INT AS quantity,
 CASE p_partkey % 6 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN least(100, CAST(value AS DECIMAL(10,2))) ELSE 100 END::DECIMAL(5,2) AS percent
FROM ({_BIG})""")

# Every seventh order has an amount of eleven digits, every ninth line a quantity or a price that does not fit.
_ORDERS = dirty.RAW["orders"]
_WIDE = {
    "products": dirty.RAW["products"].replace("CASE WHEN p_partkey % 37 = 0 THEN '0'", "CASE WHEN p_partkey % 13 = 0 THEN '1,234,567,890.10' WHEN p_partkey % 37 = 0 THEN '0'"),
    "orders": _ORDERS.replace("CASE WHEN o_orderkey % 71 = 0 THEN '-'", "CASE WHEN o_orderkey % 7 = 0 THEN '99999999999.00' WHEN o_orderkey % 71 = 0 THEN '-'"),
    "order_items": dirty.RAW["order_items"].replace("CASE l_linenumber % 7 WHEN 0 THEN '0'", "CASE WHEN l_orderkey % 9 = 0 THEN '99999999999' WHEN l_linenumber % 7 = 0 THEN '0'")
    .replace("WHEN 1 THEN '2.9' WHEN 2 THEN 'x' ELSE CAST(CAST(l_quantity", "WHEN l_linenumber % 7 = 1 THEN '2.9' WHEN l_linenumber % 7 = 2 THEN 'x' ELSE CAST(CAST(l_quantity"),
    "customers": dirty.RAW["customers"],
}


def _rejects(s, f) -> DataFrame:
    """The silver run over such files: rejected values beside the rows that got through."""
    lake = new_lake(s)
    for name, text in _WIDE.items():
        rows = dirty.frame(s, f, text).drop("_load").withColumn("_ingested_at", F.make_timestamp(*map(F.lit, (2024, 1, 1, 0, 0, 0))))
        publish.append(lake, ENTITIES[name].bronze_table, rows)
    silver.run_silver(lake)
    rejected = lake.read("bronze", silver.REJECTED).groupBy("table", "column").agg(F.count("*").alias("rejected"))
    kept = [lake.read("silver", t).agg(F.lit(t).alias("table"), F.count("*").alias("kept")) for t in ("products", "orders")]
    return rejected.join(kept[0].unionByName(kept[1]), "table", "left")


add("cln_oversize_rejects", _rejects, query([c.replace(dirty.with_second_load(e), f"SELECT * FROM ({_WIDE[e]}) w") for c, e in zip(
    dirty.CLEANED[:3], ("customers", "products", "orders"))], f"""SELECT 'products' AS "table", 'selling_price' AS "column", count(*) AS rejected,
 (SELECT count(*) FROM prod) AS kept FROM part WHERE p_partkey % 13 = 0
UNION ALL SELECT 'orders', 'total_amount', count(*), (SELECT count(*) FROM ord) FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'order_items', 'quantity', count(DISTINCT item_id), NULL FROM ({_WIDE['order_items']}) WHERE quantity = '99999999999'""").replace(
    "CAST(round(coalesce(", "TRY_CAST(round(coalesce("))



def _rejects_once(s, f) -> DataFrame:
    """Four runs over three deliveries, the customers in the second one: every rejected value once, nothing left for the last run."""
    lake = new_lake(s)
    third = F.pmod(F.xxhash64("_row_id"), F.lit(3))
    arriving = {"products": (F.lit(True), F.lit(False), F.lit(False)), "customers": (F.lit(False), F.lit(True), F.lit(False)),
                "orders": (third == 0, third == 1, third == 2), "order_items": (third == 2, third == 0, third == 1)}
    for n in range(3):
        for name, text in _WIDE.items():
            rows = dirty.frame(s, f, text).drop("_load").withColumn("_ingested_at", F.make_timestamp(*map(F.lit, (2024, 1, n + 1, 0, 0, 0))))
            publish.append(lake, ENTITIES[name].bronze_table, rows.filter(arriving[name][n]))
        silver.run_silver(lake)
    left_over = silver.run_silver(lake).agg(F.sum("candidates")).first()[0]
    rejected = lake.read("bronze", silver.REJECTED).groupBy("table", "column").agg(F.count("*").alias("rejected"), F.countDistinct("key").alias("different"))
    kept = [lake.read("silver", t).agg(F.lit(t).alias("table"), F.count("*").alias("kept")) for t in ("products", "orders")]
    return rejected.join(kept[0].unionByName(kept[1]), "table", "left").withColumn("left_over", F.lit(left_over))


add("pipe2_rejects_once", _rejects_once, SQL["cln_oversize_rejects"].replace("SELECT 'products' AS", "SELECT *, rejected AS different, 0::BIGINT AS left_over FROM (SELECT 'products' AS") + ")")

# --- fine decimals ----------------------------------------------------------------------------------

_FINE = "CAST(p_partkey % 1000 AS DECIMAL(18,6)) / CAST(1000000 AS DECIMAL(7,0))"


def _fine_tiles(s, f) -> DataFrame:
    """Keys that differ in the sixth decimal, beside one of doubles."""
    rows = Retail(s, f).silver.raw("part").selectExpr("p_partkey", f"cast(1 + {_FINE} as decimal(18,6)) as fine", "p_retailprice / 7 as price")
    tiles = ranking.ntile_columns(rows, "p_partkey", {"tile": Scale(F.col("fine")), "price_tile": Scale(F.col("price"), descending=True)}, 9)
    return rows.select("p_partkey", *[c.alias(n) for n, c in tiles.items()])


add("win1_ntile_six_decimals", _fine_tiles, """SELECT p_partkey, CAST(ntile(9) OVER (ORDER BY p_partkey % 1000, p_partkey) AS INT) AS tile,
 CAST(ntile(9) OVER (ORDER BY p_retailprice / 7 DESC, p_partkey) AS INT) AS price_tile FROM part""")


def _fine_sum(s, f) -> DataFrame:
    rows = Retail(s, f).silver.raw("part").selectExpr("p_partkey", "cast(p_partkey as decimal(20,8)) / 1 + cast(0.12345678 as decimal(9,8)) as v")
    rows = rows.withColumn("v", F.col("v").cast("decimal(20,8)"))
    out = ranking.global_running_sum(rows, [F.col("p_partkey")], "v")
    return out.select("p_partkey", F.col("running_sum").cast("decimal(28,8)").alias("running_sum"))


add("win2_running_sum_eight_decimals", _fine_sum, """SELECT p_partkey, CAST(sum(CAST(p_partkey + 0.12345678 AS DECIMAL(20,8)))
 OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,8)) AS running_sum FROM part""")

# --- rows without a state, a channel, a stamp -------------------------------------------------------


def _no_state(s, f) -> DataFrame:
    state = F.when(F.substring("customer_id", 6, 9).cast("int") % 5 != 0, F.col("state"))
    return analysis.spend_ranks(Retail(s, f).dim_customers.withColumn("state", state))


add("ext8_spend_ranks_without_state", _no_state, query(S.CUSTOMERS + [
    "d8 AS (SELECT customer_id, CASE WHEN CAST(substr(customer_id, 6, 9) AS INT) % 5 <> 0 THEN state END AS state, lifetime_value FROM dimc)"], """
SELECT customer_id, state, lifetime_value, rank() OVER st AS state_rank, percent_rank() OVER st AS state_percent_rank,
 rank() OVER al AS overall_rank, percent_rank() OVER al AS percent_rank,
 CAST(ntile(10) OVER (ORDER BY lifetime_value DESC, customer_id) AS INT) AS decile
FROM d8 WINDOW st AS (PARTITION BY state ORDER BY lifetime_value DESC), al AS (ORDER BY lifetime_value DESC)"""))


def _no_channel(s, f) -> DataFrame:
    channel = F.when(F.col("shipping_method") != "5-LOW", F.col("shipping_method"))
    return analysis.channel_pivot(Retail(s, f).lines.withColumn("shipping_method", channel))


_NAMED = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
add("ext9_revenue_without_channel", _no_channel, query(S.SALES, "SELECT order_month, " + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN shipping_method = '{m}' THEN gross_revenue END), 0) AS DECIMAL(18,2)) AS \"{n}\""
    for m, n in [*zip(_NAMED, _NAMED), ("5-LOW", "no_channel")]) + " FROM fact WHERE is_completed GROUP BY 1"))


def _newer(s, f) -> DataFrame:
    """Half of the events at the last loaded second, and some without a stamp, come with the second load."""
    rows = Retail(s, f).silver.raw("events").selectExpr(
        "event_id", "case when event_id % 17 <> 0 then date_trunc('DAY', ts) end as ts", "cast(ts as date) as day")
    loaded = rows.filter("day < date'2024-01-10' and ts is not null or day = date'2024-01-10' and event_id % 2 = 0 and ts is not null")
    return history.newer_rows(rows, loaded, "ts", "event_id").select("event_id")


add("ext2_newer_rows_at_the_mark", _newer, """SELECT event_id FROM events WHERE event_id % 17 = 0 OR CAST(ts AS DATE) > DATE '2024-01-10'
 OR CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 2 <> 0""")


def _same_day(s, f) -> DataFrame:
    """Two changes on one day: the first of them leaves no version behind."""
    customers = Retail(s, f).silver.customers.select("customer_id", "state")
    first = history.scd2_open(customers, ["state"], F.lit("1995-01-01").cast("date"))
    once = history.scd2_apply(first, customers.withColumn("state", F.lit("A")), "customer_id", ["state"], "2000-06-16")
    return history.scd2_apply(once, customers.withColumn("state", F.lit("B")), "customer_id", ["state"], "2000-06-16").drop("row_hash")


add("ext5_scd2_same_day", _same_day, query(S.SILVER, """SELECT customer_id, state, DATE '1995-01-01' AS valid_from, DATE '2000-06-15' AS valid_to, false AS is_current FROM cust
UNION ALL SELECT customer_id, 'B', DATE '2000-06-16', NULL, true FROM cust"""))


def _loaded_twice(s, f) -> DataFrame:
    """A growing event table loaded in turn: up to the middle of a day, then all of it, then again."""
    rows = Retail(s, f).silver.raw("events").selectExpr("event_id", "case when event_id % 17 <> 0 then date_trunc('DAY', ts) end as ts", "cast(ts as date) as day")
    lake, some = new_lake(s), rows.filter("day < date'2024-01-10' or day = date'2024-01-10' and event_id % 2 = 0")
    counts = [bronze.load_newer(lake, "events", part, "event_id", "ts").rows_processed for part in (some, rows, rows)]
    table = lake.read("bronze", "events")
    return table.agg(*[F.lit(n).cast("long").alias(f"load_{i}") for i, n in enumerate(counts, 1)], F.count("*").alias("rows"),
                     F.count_distinct("event_id").alias("ids"), F.count_distinct("_file_row_hash").alias("hashes"))


add("ext2_incremental_load", _loaded_twice, """SELECT count(*) FILTER (early) AS load_1, count(*) FILTER (NOT early) AS load_2, 0::BIGINT AS load_3,
 count(*) AS "rows", count(*) AS ids, count(*) AS hashes
FROM (SELECT CAST(ts AS DATE) < DATE '2024-01-10' OR CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 2 = 0 AS early FROM events)""")


def _history_table(s, f) -> DataFrame:
    """Two snapshots of the customers published as a history."""
    lake, customers = new_lake(s), Retail(s, f).silver.customers.select("customer_id", "state")
    moved = customers.withColumn("state", F.when(F.col("state") == "FRANCE", "GERMANY").otherwise(F.col("state")))
    for rows, day in ((customers, "1995-01-01"), (moved, "2000-06-16"), (moved, "2001-01-01")):
        history.publish_history(lake, "customers", rows, "customer_id", ["state"], day)
    return lake.read(history.HISTORY, "customers").drop("row_hash")


add("ext5_history_table", _history_table, query(S.SILVER, """SELECT customer_id, state, DATE '1995-01-01' AS valid_from,
 CASE WHEN state = 'FRANCE' THEN DATE '2000-06-15' END AS valid_to, state <> 'FRANCE' AS is_current FROM cust
UNION ALL SELECT customer_id, 'GERMANY', DATE '2000-06-16', NULL, true FROM cust WHERE state = 'FRANCE'"""))

# --- streams --------------------------------------------------------------------------------------


def _late_parents(s, f) -> DataFrame:
    """Orders come before their customers; a later order and a retry bring the waiting ones in."""
    lake, state = new_lake(s), _checkpoint(s)
    orders = dirty.bronze(s, f, "orders").filter("_load = 1").drop("_load")
    customers = silver.clean_customers(silver.last_written(dirty.bronze(s, f, "customers"), "customers"))
    early = F.substring("customer_id", 6, 9).cast("int") % 3
    publish.rebuild(lake, "silver", "customers", customers.filter(early == 0))
    for part, arriving in ((F.col("_row_id") % 2 == 0, 1), (F.col("_row_id") % 2 == 1, 2)):
        orders.filter(part).write.mode("append").parquet(lake.path("bronze", "raw_orders"))
        ingest.stream_to_silver(lake, "orders", silver.clean_orders, state, parents=["customers"]).awaitTermination()
        publish.upsert(lake, "silver", "customers", customers.filter(early == arriving), "customer_id")
    ingest.load_waiting(lake, "orders", silver.clean_orders, ["customers"])
    return current_rows(lake, "silver", "orders", "order_id").drop("_updated_at")


add("str3_late_parents", _late_parents, query([dirty.CLEAN_CUSTOMERS, dirty.CLEANED[2].replace(dirty.with_second_load("orders"), dirty.RAW["orders"])], "SELECT * FROM ord"))


def _late_lines(s, f) -> DataFrame:
    """Lines in three batches, the oldest last, with the increments folded in between."""
    r, lake, state = Retail(s, f), new_lake(s), _checkpoint(s)
    lines = r.lines.filter("is_completed").select(F.col("order_date").cast("timestamp").alias("order_ts"), "quantity", "gross_revenue", "gross_profit")
    folder = scratch.new_path(s, "lines")
    for low, high in (("2000-01-01", "2100-01-01"), ("1997-01-01", "2000-01-01"), ("1900-01-01", "1997-01-01")):
        lines.filter((F.col("order_ts") >= low) & (F.col("order_ts") < high)).write.mode("append").parquet(folder)
        stream = s.readStream.schema(lines.schema).parquet(folder)
        daily.write_daily_totals(lake, stream, state).awaitTermination()
        if low == "1997-01-01":
            compact_sums(lake, "gold", "daily_totals", "order_date")
    return sum_of_changes(lake, "gold", "daily_totals", "order_date")


add("str4_late_lines", _late_lines, query(S.SALES, f"""SELECT order_date, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units_sold,
 {total('gross_revenue')} AS gross_revenue, {total('gross_profit')} AS gross_profit FROM fact WHERE is_completed GROUP BY 1"""))


def _repeated_ids(s, f) -> DataFrame:
    """Ids that come again in later batches, months late, over buckets that are folded in between."""
    rows = Retail(s, f).silver.raw("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"))
    out, state, folder = scratch.new_path(s, "events"), _checkpoint(s), scratch.new_path(s, "incoming")
    for n, part in enumerate(("event_id % 2 = 0", "event_id % 3 = 0", "true")):
        rows.filter(part).write.mode("append").parquet(folder)
        stream = s.readStream.schema(rows.schema).parquet(folder)
        events.store_distinct_events(stream, out, state, buckets=4).awaitTermination()
        if n == 1:
            events.compact_events(s, out, keep_from=2)
    return _stored_events(s, out)


add("str2_repeated_ids", _repeated_ids, _EVENTS)
add("str3_changes_by_layer", lambda s, f: _two_layers(s, f), query(S.SILVER, """SELECT 'silver' AS layer, count(*) AS n FROM cust
UNION ALL SELECT 'gold', count(*) FROM cust WHERE state = 'FRANCE'"""))


def _two_layers(s, f) -> DataFrame:
    """A silver and a gold table of one name with pending changes of their own."""
    from tallyhouse.operators.changes import write_changes

    lake, rows = new_lake(s), Retail(s, f).silver.customers.select("customer_id", "state")
    write_changes(lake, "silver", "t", rows, 0)
    write_changes(lake, "gold", "t", rows.filter("state = 'FRANCE'"), 0)
    compact(lake, "gold", "t", "customer_id")
    return current_rows(lake, "silver", "t", "customer_id").agg(F.lit("silver").alias("layer"), F.count("*").alias("n")).unionByName(
        current_rows(lake, "gold", "t", "customer_id").agg(F.lit("gold").alias("layer"), F.count("*").alias("n")))


def _second_run(s, f) -> DataFrame:
    """A silver run over a part of the customers, then one over the rest and changed rows of all tables."""
    lake = new_lake(s)
    late = F.col("_row_id") % 3 != 0

    def deliver(load: int, name: str, rows: DataFrame) -> None:
        stamped = rows.filter(F.col("_load") == load).drop("_load")
        publish.append(lake, ENTITIES[name].bronze_table, stamped.withColumn("_ingested_at", F.make_timestamp(*map(F.lit, (2024, 2, load, 0, 0, 0)))))

    names = ("customers", "products", "orders", "order_items")
    for name in names:
        rows = dirty.bronze(s, f, name)
        deliver(1, name, rows.filter(~late) if name == "customers" else rows)
    silver.run_silver(lake)
    for name in names:
        deliver(2, name, dirty.bronze(s, f, name))
    silver.run_silver(lake)
    # A third run finds only what comes once more.
    deliver(2, "order_items", dirty.bronze(s, f, "order_items"))
    third = silver.run_silver(lake).filter("table = 'order_items'").first()
    return lake.read("silver", "order_items").drop("_updated_at").withColumn("again", F.lit(third.written > 0))


add("pipe2_second_run", _second_run, query(dirty.CLEANED, "SELECT *, true AS again FROM item"))

# --- files, log and whole run -----------------------------------------------------------------------


def _column_check(s, f) -> DataFrame:
    """A file that lacks a column fails, one with an extra column loads."""
    lake, files = new_lake(s), scratch.new_path(s, "csv")
    publish.export_csv(dirty.raw(s, f, "products").drop("sku"), f"{files}/products.csv")
    publish.export_csv(dirty.raw(s, f, "customers").withColumn("extra", F.lit("x")), f"{files}/customers.csv")
    return bronze.run_bronze(lake, files, ["customers", "products"], strict=False)


add("sch1_column_check", _column_check, """SELECT 'customers' AS entity, 'success' AS status, count(*) AS rows_processed, 0::BIGINT AS rows_skipped, NULL::VARCHAR AS error FROM customer
UNION ALL SELECT 'products', 'failed', 0, 0, '[products] Missing expected columns: [''sku'']'""")


def _last_in_file(s, f) -> DataFrame:
    """Every order twice in its file, in files of bounded size: the row further down wins."""
    path = f"{scratch.new_path(s, 'csv')}/orders.csv"
    text = dirty.frame(s, f, dirty.with_second_load("orders"))
    files = ceil(Retail(s, f).silver.raw("orders").count() / scratch.ROWS_PER_PARTITION)
    rows = text.repartition(max(1, files), "_row_id").sortWithinPartitions("_load", "_row_id")
    publish.export_csv(rows.select(*ENTITIES["orders"].columns), path)
    latest = keys.latest_per_key(scan_csv(s, ENTITIES["orders"], path), "order_id", F.desc("_row_id"))
    return latest.select("order_id", "shipping_method", "order_status")


add("sch4_last_in_file", _last_in_file, f"SELECT order_id, shipping_method, order_status FROM {dirty._latest('orders', 'order_id')}")


def _stamped(s, f) -> DataFrame:
    """Rows stamped during their run."""
    lake, start = new_lake(s), s.sql("SELECT current_timestamp() AS t").first().t
    publish.append(lake, "raw_customers", dirty.bronze(s, f, "customers").drop("_load"))
    rows = silver.clean_customers(silver.last_written(lake.read("bronze", "raw_customers"), "customers"))
    table = publish.rebuild(lake, "silver", "customers", rows)
    return table.agg(F.count_if(F.col("_updated_at").between(F.lit(start), F.current_timestamp())).alias("stamped"), F.count("*").alias("rows"))


add("sch10_updated_at", _stamped, query([dirty.CLEAN_CUSTOMERS], "SELECT count(*) AS stamped, count(*) AS \"rows\" FROM cust"))


def _freshness(s, f) -> DataFrame:
    """A run log with one run per order year, ended at its last ship date; the odd years failed."""
    lake, orders = new_lake(s), Retail(s, f).orders
    for r in orders.groupBy("order_year").agg(F.max("ship_date").alias("last")).collect():
        ended = dt.datetime.combine(r["last"], dt.time())
        bronze.log_run(lake, "bronze_loader", "failed" if r.order_year % 2 else "success", 1, ended - dt.timedelta(hours=1), ended)
    return reports.freshness(lake.read("bronze", bronze.RUN_TABLE)).select(F.col("last_run").cast("date").alias("last_run"))


add("rpt27_freshness", _freshness, query(S.STAGED, "SELECT max(ship_date) AS last_run FROM s_ord WHERE order_year % 2 = 0"))

_DATED = dirty.RAW["customers"].replace("'not-a-date'", "'1995-01-15'")


def _run_all(s, f) -> DataFrame:
    """CSV files through the one-call run with all its checks; returns the published daily sales."""
    lake, files = new_lake(s), csv_folder(s, f, *[e for e in ENTITIES if e != "customers"])
    publish.export_csv(dirty.frame(s, f, _DATED).drop("_row_id", "_load"), f"{files}/customers.csv")
    runs.run_all(lake, files, START, END, AS_OF)
    return lake.read("gold", "daily_sales")


_ONE_LOAD = [c.replace(dirty.with_second_load(e), _DATED if e == "customers" else dirty.RAW[e]) for c, e in zip(
    dirty.CLEANED, ("customers", "products", "orders", "order_items"))]
add("pipe5_run_all", _run_all, query(_ONE_LOAD + [S.STAGING, S.DATES, S.LINES, _DAILY], "SELECT * FROM daily"))
