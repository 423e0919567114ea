"""Daily sales kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.functions.numbers import money
from tallyhouse.operators import scratch
from tallyhouse.operators.changes import current_rows, sum_of_changes, write_changes
from tallyhouse.sources.tables import Lake


def daily_totals(lines: DataFrame, timestamp: str = "order_ts") -> DataFrame:
    """Additive measures per day of completed order lines.

    Distinct counts, running sums and the top category do not add up over batches; recompute them for
    the touched days with ``plans.marketing.refresh_days``.
    """
    return lines.groupBy(F.col(timestamp).cast("date").alias("order_date")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units_sold"),
        money(F.sum("gross_revenue")).alias("gross_revenue"),
        money(F.sum("gross_profit")).alias("gross_profit"),
    )


def write_daily_totals(lake: Lake, lines: DataFrame, checkpoint: str, timestamp: str = "order_ts", table: str = "daily_totals") -> StreamingQuery:
    """Write what each batch of lines adds to its days; ``operators.changes.sum_of_changes`` reads the current state.

    There is no watermark and no state: a line counts however late it comes, and a repeated batch
    overwrites its own increment. ``operators.changes.compact_sums`` folds the increments now and then.
    """
    return (
        lines.writeStream
        .foreachBatch(lambda batch, batch_id: write_changes(lake, "gold", table, daily_totals(batch, timestamp), batch_id))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


MEASURES = ("lines", "units_sold", "gross_revenue", "gross_profit")


def write_windowed_totals(lake: Lake, lines: DataFrame, checkpoint: str, delay: str = "3 days", timestamp: str = "order_ts",
                          table: str = "windowed_totals") -> StreamingQuery:
    """Daily totals from tumbling one-day windows in a state store; ``windowed_totals`` reads them.

    State holds a row per day and ends with the watermark, so it stays as small as ``delay``. A batch rewrites the totals
    of its open days. Spark leaves out all lines of a day whose window is closed; such a day shows by having lines in the batch
    but no window, and its lines are written as an increment (``operators.changes``), as are lines without a time. Days
    are those of the session's clock. A repeated batch overwrites what it wrote.
    """
    # Windows begin at midnight UTC: the time is shifted so that its UTC clock shows the session's.
    zone = lines.sparkSession.conf.get("spark.sql.session.timeZone")
    timed = lines.withColumn("_at", F.from_utc_timestamp(timestamp, zone))
    windows = timed.withWatermark("_at", delay).groupBy(F.window("_at", "1 day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units_sold"),
        money(F.sum("gross_revenue")).alias("gross_revenue"), money(F.sum("gross_profit")).alias("gross_profit"))
    start = F.floor(F.unix_seconds("window.start") / 86400).cast("int")
    open_days = windows.select(F.date_from_unix_date(start).alias("order_date"), *MEASURES, F.lit(True).alias("_window"))
    each = timed.select(
        F.col(timestamp).cast("date").alias("order_date"), F.lit(1).cast("long").alias("lines"), F.col("quantity").cast("long").alias("units_sold"),
        money(F.col("gross_revenue")).alias("gross_revenue"), money(F.col("gross_profit")).alias("gross_profit"), F.lit(False).alias("_window"))

    def load(batch: DataFrame, batch_id: int) -> None:
        types = {f.name: f.dataType for f in batch.schema}
        with scratch.scope(batch.sparkSession):
            by_day, _ = scratch.store(batch.groupBy("order_date").agg(
                F.max("_window").alias("_open"),
                *[F.max(F.when(F.col("_window"), F.col(m))).alias(f"{m}_window") for m in MEASURES],
                *[F.sum(F.when(~F.col("_window"), F.col(m))).cast(types[m]).alias(f"{m}_each") for m in MEASURES]), "window-days")
            for part, of, name in ((by_day.filter("_open"), "window", f"{table}_open"), (by_day.filter("NOT _open"), "each", f"{table}_late")):
                write_changes(lake, "gold", name, part.select("order_date", *[F.col(f"{m}_{of}").alias(m) for m in MEASURES]), batch_id)

    return (
        open_days.unionByName(each).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def windowed_totals(lake: Lake, table: str = "windowed_totals") -> DataFrame:
    """Totals per day: the last ones of its window and what came after the window was closed."""
    rows = current_rows(lake, "gold", f"{table}_open", "order_date").select("order_date", *MEASURES)
    late = sum_of_changes(lake, "gold", f"{table}_late", "order_date").select("order_date", *MEASURES)
    types = {f.name: f.dataType for f in rows.schema}
    return rows.unionByName(late).groupBy("order_date").agg(*[F.sum(m).cast(types[m]).alias(m) for m in MEASURES])
