"""Streams whose state ends with the watermark, against the batch."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.streaming import daily, events


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


SCHEMA = "event_id string, event_timestamp timestamp, page string"


def arrive(spark, tmp_path, rows, delay="1 hour"):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(i, m, p) for i, m, p in rows], "event_id string, m int, page string").select(
        "event_id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("m"))).alias("event_timestamp"), "page",
    ).write.mode("append").parquet(source)
    query = events.store_events_by_day(spark.readStream.schema(SCHEMA).parquet(source), out, state, delay)
    query.awaitTermination()
    return query, out


DAY = 24 * 60


def test_late_rows_are_kept_once(spark, tmp_path):
    arrive(spark, tmp_path, [("a", 0, "x"), ("a", 0, "x"), ("b", 30, "x"), ("n", None, "x")])
    arrive(spark, tmp_path, [("a", 0, "x"), ("c", 10 * DAY, "x")])  # a copy inside the delay
    # Far behind: copies of a and b, d that is new and comes twice, n without a time again; c once more. Rows without an id count as one id.
    arrive(spark, tmp_path, [("a", 0, "x"), ("b", 30, "x"), ("d", 40, "x"), ("d", 40, "x"), ("n", None, "x"), ("c", 10 * DAY, "x")])
    _, out = arrive(spark, tmp_path, [("d", 40, "x"), ("e", 10 * DAY + 5, "x"), (None, 10 * DAY, "x"), (None, 3, "x"), (None, 3, "x")])
    got = sorted((r.event_id or "", r.day) for r in spark.read.schema("event_id string, day string").parquet(out).collect())
    assert got == [("", "2024-01-11"), ("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-11"), ("d", "2024-01-01"), ("e", "2024-01-11"), ("n", "none")]


def test_ordinary_batches_open_no_stored_row(spark, tmp_path):
    _, out = arrive(spark, tmp_path, [("a", 0, "x"), ("b", 5, "x")])
    arrive(spark, tmp_path, [("c", 10 * DAY, "x")])
    # A stored file that cannot be read: batches of other days don't notice.
    folder = next((tmp_path / "out" / "day=2024-01-01").iterdir())
    (folder / "part-broken.parquet").write_bytes(b"no parquet at all")
    query, _ = arrive(spark, tmp_path, [("c", 10 * DAY, "x"), ("d", 10 * DAY + 1, "x")])
    ids = spark.read.parquet(str(tmp_path / "out" / "day=2024-01-11"))
    assert sorted(r.event_id for r in ids.collect()) == ["c", "d"]
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 2  # a and b have left the state
    with pytest.raises(Exception, match="part-broken"):
        arrive(spark, tmp_path, [("a", 0, "x")])


def test_repeated_batch(spark, tmp_path):
    """A batch that fails after it has written its rows writes them again."""
    arrive(spark, tmp_path, [("a", 0, "x")])
    arrive(spark, tmp_path, [("b", 10 * DAY, "x")])
    write, events.files.write_text = events.files.write_text, None
    try:
        with pytest.raises(Exception):
            arrive(spark, tmp_path, [("a", 0, "x"), ("z", 1, "x"), ("c", 10 * DAY, "x")])
    finally:
        events.files.write_text = write
    _, out = arrive(spark, tmp_path, [("z", 1, "x")])
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "z"]


def test_windowed_totals(spark, lake, tmp_path):
    source, state = str(tmp_path / "lines"), str(tmp_path / "totals")
    schema = "order_ts timestamp, quantity int, gross_revenue decimal(18,2), gross_profit decimal(18,2)"

    def lines(days):
        return spark.createDataFrame([(d,) for d in days], "d int").select(
            F.when(F.col("d").isNotNull(), F.expr("timestamp'2024-01-01 23:30:00' + make_dt_interval(d)")).alias("order_ts"), F.lit(2).alias("quantity"),
            F.lit(1.25).cast("decimal(18,2)").alias("gross_revenue"), F.lit(0.5).cast("decimal(18,2)").alias("gross_profit"))

    for days in ([0, 0, 1], [1, 2, 30], [0, 1, 30, None], [31, 0, 200]):
        lines(days).write.mode("append").parquet(source)
        query = daily.write_windowed_totals(lake, spark.readStream.schema(schema).parquet(source), state)
        query.awaitTermination()
        want = daily.daily_totals(spark.read.schema(schema).parquet(source))
        got = daily.windowed_totals(lake)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 1
    late = spark.read.parquet(lake.path("changes", "gold.windowed_totals_late"))
    assert {str(r.order_date) for r in late.collect()} == {"2024-01-01", "2024-01-02", "None"}
