"""Writing tables: append, full rebuild, keyed upsert, CSV export."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.operators import scratch
from tallyhouse.operators.buckets import sweep, upsert_buckets
from tallyhouse.schemas import ENTITIES
from tallyhouse.sources.tables import LOAD, Lake, drop_old_versions, next_version

# Tables whose every append is a load in a folder of its own, so that what is new can be read alone.
BY_LOAD = frozenset(e.bronze_table for e in ENTITIES.values())


def counted_rows(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills while some later action runs over it."""
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_of(seen: Observation, counter: str = "rows") -> int:
    """The counter's value. A part of the plan that Spark found empty reports nothing."""
    return int(seen.get.get(counter, 0) or 0)


def append(lake: Lake, table: str, df: DataFrame) -> None:
    """Add rows to a bronze table; to one of raw rows as a load, whose id sorts by time."""
    path = lake.path("bronze", table)
    if table in BY_LOAD:
        path = f"{path}/{LOAD}={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    with scratch.tidy(lake.spark):
        df.write.mode("append").option(*scratch.PACKED).parquet(path)


def rebuild(lake: Lake, layer: str, table: str, df: DataFrame, partition_by: str | None = None,
            sort_by: str | None = None, keep: int = 2, widen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Write a full new version and return it. The old one stays readable until this one is complete.

    ``widen`` gives the rows of a partitioned table more columns once they are where they belong.
    """
    path = lake.path(layer, table)
    if partition_by:
        # Rebalancing sizes the files of a partition value by volume: a value that holds a large share
        # of the rows is split over tasks, small ones do not scatter over all of them.
        df = df.hint("rebalance", partition_by)
        df = widen(df) if widen else df
        df = df.sortWithinPartitions(partition_by, *([sort_by] if sort_by else []))
    writer = df.write.mode("overwrite").option(*scratch.PACKED)
    with scratch.tidy(lake.spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(next_version(lake.spark, path))
    drop_old_versions(lake.spark, path, keep)
    sweep(lake, layer, table)
    return lake.read(layer, table)


def upsert(lake: Lake, layer: str, table: str, df: DataFrame, key: str, stored: bool = False) -> DataFrame:
    """Put rows into a table, replacing those with an equal key; only buckets with such rows are rewritten.

    ``stored``: ``df`` reads an intermediate table, and need not be stored for its passes.
    """
    return upsert_buckets(lake, layer, table, df, key, stored=stored)


def compact_files(lake: Lake, layer: str, table: str, partition_by: str | None = None) -> DataFrame:
    """Rewrite a table in evenly sized files."""
    df = lake.read(layer, table)
    return rebuild(lake, layer, table, df if partition_by else df.hint("rebalance"), partition_by)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; quotes are doubled and blanks kept, as the CSV scan reads them."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
