"""Row selection by key: last write wins, known keys, foreign keys, snapshot merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """One row per key: the first in the given order.

    Spark limits each map task to one row per key before the shuffle, so a key with very many copies
    does not travel.
    """
    order = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def known_keys(df: DataFrame, key: str) -> DataFrame:
    """Every key of a table once."""
    return df.select(key).distinct()


def without_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known`` yet. A NULL key is never known."""
    return df.join(known.select(key), key, "left_anti")


def with_parent(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``."""
    return df.join(parent.select(key), key, "left_semi")


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose non-NULL key is missing in ``parent``."""
    names = parent.select(F.col(parent_key or key).alias(key))
    return df.filter(F.col(key).isNotNull()).join(names, key, "left_anti")


def merged(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``source`` put in, replacing equal keys."""
    return without_known(target, source, key).unionByName(source)
