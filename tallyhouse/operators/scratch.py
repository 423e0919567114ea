"""Intermediate tables in the folder the cluster shares.

Some operators need two passes over one fixed arrangement of the rows. They write it as a table, which
survives lost executors, under ``spark.checkpoint.dir``, or under Spark's warehouse folder where that is
not set (the other folder that driver and executors share).

Everything goes into one folder per application, which Hadoop deletes when the driver ends. ``scope``
deletes what was made inside it as soon as its block ends. Inside ``scope``, ``partitions_for`` and ``tidy`` the files
of a query's shuffles go when the query ends; else they stay until the driver happens to collect its garbage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from math import ceil

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources import files

# A partition of a shuffle is made for so many rows; with more of them a task would sort beyond its memory and spill.
ROWS_PER_PARTITION = 250_000
# How tables are written: stored text takes half the room of Spark's default, in the same time.
PACKED = ("compression", "zstd")
# Spark's setting for what becomes of a query's shuffle files once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scopes: list[list[str]] = []
_tables: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@lru_cache(maxsize=None)
def _application_folder(top: str, application: str) -> str:
    path = f"{top}/tallyhouse-{application}-{uuid.uuid4().hex[:8]}"
    files.make_until_exit(SparkSession.active(), path)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{_application_folder(shared_folder(spark), spark.sparkContext.applicationId)}/{label}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table and read it back; also returns the path, for ``discard``."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option(*PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def store_by(df: DataFrame, key: str, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``key`` and read it back: joins and groupings by the key then don't move it.

    As many buckets as the session has shuffle partitions. The table's name is only known to this session.
    ``path``: a path from ``new_path``, for ``discard``.
    """
    spark, path = df.sparkSession, path or new_path(df.sparkSession, label)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"scratch_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.option(*PACKED).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    _tables[path] = name
    return spark.table(name)


def discard(spark: SparkSession, path: str) -> None:
    if path in _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
    files.delete(spark, path)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every query that runs inside the block are deleted when the query ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


@contextmanager
def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> Iterator[None]:
    """Shuffles of what runs inside the block get as many partitions as a table of so many rows needs.

    At least as many as the session sets; adaptive execution merges those that turn out small, but splits none that is large.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), ceil(rows / rows_per_partition))))
    try:
        with tidy(spark):
            yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end of the block, also when it fails.

    DataFrames that read them must have been written or collected by then.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        with tidy(spark):
            yield
    finally:
        _scopes.remove(made)
        for path in made:
            discard(spark, path)
