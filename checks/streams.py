"""Streaming forms, run to completion over the test tables and read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import dirty
from checks import sql as S
from checks.gold import _DAILY
from checks.layers import csv_folder, new_lake, raw_sql
from checks.retail import Retail
from checks.sql import query, total
from tallyhouse.operators import scratch
from tallyhouse.operators.changes import compact, current_rows, sum_of_changes
from tallyhouse.plans import marketing, silver
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.star_adapter import RAW_SCHEMAS
from tallyhouse.streaming import daily, events, ingest

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql is not None:
        SQL[name] = sql


def _stream(spark, folder: str, table: str) -> DataFrame:
    return spark.readStream.schema(RAW_SCHEMAS[table]).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def _checkpoint(spark) -> str:
    return scratch.new_path(spark, "stream")


def _bronze(spark, folder) -> DataFrame:
    """Two runs of the stream over one folder: the second finds nothing new."""
    lake, files = new_lake(spark), csv_folder(spark, folder, "orders")
    state = _checkpoint(spark)
    for _ in range(2):
        ingest.stream_to_bronze(lake, ENTITIES["orders"], f"{files}/orders.csv", state).awaitTermination()
    return lake.read("bronze", "raw_orders").select(*ENTITIES["orders"].columns)


add("str1_stream_to_bronze", _bronze, raw_sql("orders"))


def _doubled_events(spark, folder) -> DataFrame:
    """Every event twice."""
    return _stream(spark, folder, "events").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"))


def _stored_events(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", F.col("event_timestamp").cast("date").alias("day"))


def _events(spark, folder) -> DataFrame:
    out = scratch.new_path(spark, "events")
    events.write_events(events.distinct_events(_doubled_events(spark, folder)), out, _checkpoint(spark)).awaitTermination()
    return _stored_events(spark, out)


def _events_by_table(spark, folder) -> DataFrame:
    out = scratch.new_path(spark, "events")
    events.store_distinct_events(_doubled_events(spark, folder), out, _checkpoint(spark)).awaitTermination()
    return _stored_events(spark, out)


_EVENTS = "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events"
add("str2_event_dedup", _events, _EVENTS)
add("str2_event_dedup_by_table", _events_by_table, _EVENTS)


def _events_by_day(spark, folder) -> DataFrame:
    """Every event twice, first the later two thirds of the days, then all: copies inside the delay, after it and far behind."""
    out, state, source = scratch.new_path(spark, "events"), _checkpoint(spark), scratch.new_path(spark, "incoming")
    rows = spark.read.schema(RAW_SCHEMAS["events"]).parquet(f"{folder}/events.parquet").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"))
    for part in ("month(event_timestamp) % 3 > 0", "true", "event_id % 7 = 0"):
        rows.filter(part).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        events.store_events_by_day(stream, out, state, "2 days").awaitTermination()
    return _stored_events(spark, out)


add("str2_events_by_day", _events_by_day, _EVENTS)


def _silver(spark, folder) -> DataFrame:
    """Two loads of the customer text, streamed into silver in turn, with a compaction between."""
    lake, state = new_lake(spark), _checkpoint(spark)
    rows = dirty.bronze(spark, folder, "customers")
    for load in (1, 2):
        rows.filter(F.col("_load") == load).drop("_load").write.mode("append").parquet(lake.path("bronze", "raw_customers"))
        ingest.stream_to_silver(lake, "customers", silver.clean_customers, state).awaitTermination()
        if load == 1:
            compact(lake, "silver", "customers", "customer_id")
    return current_rows(lake, "silver", "customers", "customer_id").drop("_updated_at")


add("str3_stream_to_silver", _silver, query([dirty.CLEAN_CUSTOMERS], "SELECT * FROM cust"))


def _totals(spark, folder) -> DataFrame:
    """Order headers as a stream against the stored lines."""
    r, lake = Retail(spark, folder), new_lake(spark)
    stream = _stream(spark, folder, "orders").filter("o_orderstatus = 'F'").select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"))
    lines = r.lines.select("order_id", "quantity", "gross_revenue", "gross_profit")
    daily.write_daily_totals(lake, stream.join(lines, "order_id"), _checkpoint(spark)).awaitTermination()
    return sum_of_changes(lake, "gold", "daily_totals", "order_date")


add("str4_daily_totals", _totals, query(S.SALES, f"""SELECT order_date, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units_sold,
 {total('gross_revenue')} AS gross_revenue, {total('gross_profit')} AS gross_profit FROM fact WHERE is_completed GROUP BY 1"""))


def _windowed(spark, folder) -> DataFrame:
    """Stored lines in three arrivals: most orders, then older ones that their windows no longer take, then the rest."""
    r, lake, source, state = Retail(spark, folder), new_lake(spark), scratch.new_path(spark, "incoming"), _checkpoint(spark)
    lines = r.lines.filter("is_completed").select(F.col("order_date").cast("timestamp").alias("order_ts"), "quantity", "gross_revenue", "gross_profit",
                                                  F.pmod(F.xxhash64("order_id"), F.lit(4)).alias("part"))
    for part in ("part < 2", "part = 2 AND order_ts < '1996-01-01'", "part = 3 OR (part = 2 AND order_ts >= '1996-01-01')"):
        lines.filter(part).drop("part").write.mode("append").parquet(source)
        stream = spark.readStream.schema(lines.drop("part").schema).parquet(source)
        daily.write_windowed_totals(lake, stream, state).awaitTermination()
    return daily.windowed_totals(lake)


add("str4_windowed_totals", _windowed, SQL["str4_daily_totals"])


def _refresh(spark, folder) -> DataFrame:
    """Daily sales of early orders, brought up to date for the days of the later ones."""
    r = Retail(spark, folder)
    late = F.col("order_date") >= "2000-01-01"
    before = marketing.daily_sales(r.lines.filter(~late), r.dates)
    touched = r.orders.filter(late & F.col("is_completed")).select("order_date")
    return marketing.refresh_days(before, r.lines, r.dates, touched)


add("str4_refresh_days", _refresh, query(S.SALES + [_DAILY], "SELECT * FROM daily"))
