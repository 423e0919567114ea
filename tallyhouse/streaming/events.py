"""Clickstream events, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators import scratch
from tallyhouse.operators.keys import latest_per_key
from tallyhouse.sources import files


def distinct_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First row per event id; copies up to ``delay`` apart are recognised, state is dropped after that.

    Opt-in: rows later than the delay are lost here, ``store_events_by_day`` keeps them. All copies of one id
    meet in one task; where an id may have very many copies use ``store_distinct_events``.
    """
    return events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def write_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


BUCKETS = 256


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")


def store_distinct_events(events: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Events not stored yet, the earliest copy of each, without state and without losing late rows.

    Copies inside a batch are cut to one per map task before they are shuffled. Stored events lie in
    folders by a hash of the id, then by batch, so a batch looks for known ids only in the buckets its ids fall
    into; ``compact_events`` folds the batches of a bucket into one. A repeated batch overwrites its own
    folders. Batch numbers come from the checkpoint, so a path belongs to one checkpoint.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch.scope(spark):
            fresh = latest_per_key(batch, "event_id", F.asc("event_timestamp")).withColumn("bucket", _bucket(buckets))
            fresh, _ = scratch.store(fresh, "events")
            touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most `buckets`
            earlier = [f"{path}/bucket={b}/{n}" for b in touched for n in files.child_names(spark, f"{path}/bucket={b}")
                       if n.startswith("batch=") and int(n[6:]) < batch_id]
            if earlier:
                stored = spark.read.option("basePath", path).schema(fresh.schema).parquet(*earlier)
                fresh = fresh.join(stored.select("bucket", "event_id"), ["bucket", "event_id"], "left_anti")
            rows = fresh.withColumn("batch", F.lit(batch_id).cast("long"))
            # One batch touches one folder a bucket; dynamic overwriting replaces just those.
            rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)

    return (
        events.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def compact_events(spark, path: str, keep_from: int) -> None:
    """Fold the batches before ``keep_from`` into one folder a bucket, of the last of them.

    The merged rows are stored first and replace that folder; the others go after it. Ids are unique over all
    batches, so rows that a failed run left in both places are found and dropped by the next one.
    """
    folders = {b: [n for n in files.child_names(spark, f"{path}/{b}") if n.startswith("batch=") and int(n[6:]) < keep_from]
               for b in files.child_names(spark, path) if b.startswith("bucket=")}
    for bucket, batches in folders.items():
        if len(batches) < 2:
            continue
        last = max(batches, key=lambda n: int(n[6:]))
        with scratch.scope(spark):
            rows = spark.read.parquet(*[f"{path}/{bucket}/{n}" for n in batches])
            rows, _ = scratch.store(latest_per_key(rows, "event_id", F.asc("event_timestamp")), "events")
            rows.write.mode("overwrite").parquet(f"{path}/{bucket}/{last}")
        for n in batches:
            if n != last:
                files.delete(spark, f"{path}/{bucket}/{n}")


MARKS = "_marks"


def _latest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest event time, in microseconds, of the batches before this one."""
    names = [n for n in files.child_names(spark, f"{path}/{MARKS}") if int(n) < batch_id]
    text = files.read_text(spark, f"{path}/{MARKS}/{names[-1]}") if names else ""
    return int(text) if text else None


def _mark(spark: SparkSession, path: str, batch_id: int, latest: int | None) -> None:
    """Note the latest event time up to this batch; the batch before keeps its mark, for a repetition of this one."""
    files.write_text(spark, f"{path}/{MARKS}/{batch_id:012d}", "" if latest is None else str(latest))
    for name in files.child_names(spark, f"{path}/{MARKS}"):
        if int(name) < batch_id - 1:
            files.delete(spark, f"{path}/{MARKS}/{name}")


def store_events_by_day(events: DataFrame, path: str, checkpoint: str, delay: str = "1 hour") -> StreamingQuery:
    """Events by day, each id once: recent copies are recognised by state, late rows by the stored rows of their day.

    State holds the ids of the last ``delay`` only. What Spark's watermark keeps from it (rows more than ``delay`` behind the
    latest event of the batches before, and rows without a time) also arrives without state, and is compared with the stored
    rows of those days; a batch without such rows opens no stored row. The bound used here is the latest event time of all
    earlier batches, which Spark's own watermark never exceeds, so no row falls between both ways, and one that takes both
    is stored once.

    Copies of an event carry its time. Where they carry other times, those up to ``delay`` apart and those that come late on a
    day that has the event are recognised; ``store_distinct_events`` recognises all. The source is read once for each way. A
    repeated batch overwrites its own folders, and a path belongs to one checkpoint.
    """
    timed = events.filter(F.col("event_timestamp").isNotNull())
    arriving = distinct_events(timed, delay).withColumn("_by_state", F.lit(True)).unionByName(events.withColumn("_by_state", F.lit(False)))
    day = F.coalesce(F.date_format("event_timestamp", "yyyy-MM-dd"), F.lit("none"))

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        latest = _latest_before(spark, path, batch_id)
        late = F.col("event_timestamp").isNull()
        if latest is not None:
            late |= F.col("event_timestamp") <= F.timestamp_micros(F.lit(latest)) - F.expr(f"INTERVAL '{delay}'")
        with scratch.scope(spark):
            # The batch is computed once: a second pass over it would go through the state again.
            watched = batch.observe(seen, F.max(F.unix_micros("event_timestamp")).alias("latest"))
            taken = watched.filter(F.col("_by_state") | late).withColumns({"day": day, "batch": F.lit(batch_id).cast("long")})
            rows, _ = scratch.store(taken, "events")
            fresh, behind = rows.filter("_by_state").drop("_by_state"), rows.filter("NOT _by_state").drop("_by_state")
            days = [r.day for r in behind.select("day").distinct().collect()]  # one row a day
            if days:
                behind = latest_per_key(behind, "event_id", F.asc("event_timestamp"))
                known = fresh.select("event_id")
                folders = [f"{path}/day={d}/{n}" for d in days for n in files.child_names(spark, f"{path}/day={d}")
                           if n.startswith("batch=") and int(n[6:]) < batch_id]
                if folders:
                    known = known.unionByName(spark.read.option("basePath", path).schema(fresh.schema).parquet(*folders).select("event_id"))
                known = known.withColumnRenamed("event_id", "_known")
                fresh = fresh.unionByName(behind.join(known, F.col("event_id").eqNullSafe(F.col("_known")), "left_anti"))
            fresh.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)
        times = [t for t in (latest, seen.get["latest"]) if t is not None]
        _mark(spark, path, batch_id, max(times, default=None))

    return (
        arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
