"""Segmented scans against windows, with groups and ties that go over many slices."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators.segments import ROWS_PER_SLICE, in_slices, segmented


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("per_slice", [7, 100, 10_000])
def test_equals_windows(spark, per_slice):
    """A third of the rows in one group, a third of them with one value; missing groups and values."""
    i = F.col("id")
    rows = spark.range(600).select(
        "id", F.when(i % 3 == 0, "hot").when(i % 7 != 0, F.concat(F.lit("g"), (i % 40).cast("string"))).alias("g"),
        F.when(i % 9 < 3, 5).when(i % 11 != 0, i * 37 % 23).cast("int").alias("v"), (i % 13 / 4).cast("decimal(12,2)").alias("m"))
    got = segmented(rows, {"v": True, "id": False}, "g", ties=1, rank="r", percent="p", row="n", tiles=("t", 4), running=("m", "s"), rows_per_slice=per_slice)
    by_value = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    whole = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), "id")
    want = rows.select("*", F.rank().over(by_value), F.percent_rank().over(by_value), F.row_number().over(whole), F.ntile(4).over(whole),
                       F.sum("m").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(got) == rows_of(want)
    everywhere = segmented(rows, {"v": False}, rank="r", percent="p", rows_per_slice=per_slice)
    by_value = Window.orderBy(F.col("v").asc_nulls_last())
    assert rows_of(everywhere) == rows_of(rows.select("*", F.rank().over(by_value), F.percent_rank().over(by_value)))


def test_a_shared_value_does_not_meet_in_one_slice(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    sizes = in_slices(rows, {"v": False}, None, 100).groupBy("_slice").agg(F.count("id").alias("n"), F.count_if(F.col("v") == 1).alias("hot")).collect()
    assert max(r.n for r in sizes) <= 300 and sum(r.hot > 0 for r in sizes) >= 5
    assert {r.r for r in segmented(rows, {"v": False}, rank="r", rows_per_slice=100).filter("v = 1").collect()} == {1}


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "g string, v int")
    assert segmented(none, {"v": True}, "g", rank="r", tiles=("t", 3)).columns == ["g", "v", "r", "t"]
    assert segmented(none, {"v": True}, "g", rank="r").collect() == []
    one = spark.createDataFrame([("a", Decimal("1.50"))], "g string, v decimal(10,2)")
    assert [tuple(r) for r in segmented(one, {"v": True}, "g", percent="p", running=("v", "s"), tiles=("t", 3)).collect()] == [("a", Decimal("1.50"), 0.0, 1, Decimal("1.50"))]


def test_a_task_holds_a_bounded_part(spark):
    """Slices of the default size stay far below a task's memory: about 600 bytes a row, a few slices a task."""
    assert ROWS_PER_SLICE <= 250_000
    placed = in_slices(spark.range(4000).withColumn("v", F.col("id") % 5), {"v": False, "id": True}, None, 100)
    each = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n"), F.count_distinct("_slice").alias("slices")).collect()
    assert sum(r.n for r in each) == 4000 and max(r.n for r in each) <= 700
