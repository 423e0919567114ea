"""Stored tables: append-only Parquet folders and versioned snapshots.

A snapshot table is a folder of ``v=<n>`` versions. A version counts once its writer has committed
(``_SUCCESS``), so readers never see a half-written table and a failed run leaves the last good one.

A version holds its files, or a list of buckets (``operators.buckets``): where the files of each bucket
lie, many of them written for earlier versions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources import files


BUCKET_LIST = "_buckets.json"
# Layers whose tables are plain folders: appended to, or replaced partition by partition.
SUMMARIES = "summaries"
PLAIN = ("bronze", SUMMARIES)
# Folder of one load inside a bronze table of raw rows; it reads as a column.
LOAD = "load_id"


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.child_names(spark, path) if n.startswith("v=")]


def current_version(spark: SparkSession, path: str) -> str | None:
    for name in reversed(_versions(spark, path)):
        if files.exists(spark, f"{path}/{name}/_SUCCESS"):
            return f"{path}/{name}"
    return None


def next_version(spark: SparkSession, path: str) -> str:
    taken = _versions(spark, path)
    return f"{path}/v={int(taken[-1][2:]) + 1 if taken else 1:08d}"


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` committed versions."""
    done = [n for n in _versions(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]
    for name in done[:-keep]:
        files.delete(spark, f"{path}/{name}")


def bucket_list(spark: SparkSession, version: str) -> dict | None:
    """{"buckets": their number, "folders": {bucket: folder}, "rows": {bucket: rows}} of a version made of buckets."""
    path = f"{version}/{BUCKET_LIST}"
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None


@dataclass(frozen=True)
class Lake:
    """The layers under one root folder."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def has(self, layer: str, table: str) -> bool:
        path = self.path(layer, table)
        if layer in PLAIN:
            return any(not n.startswith(("_", ".")) for n in files.child_names(self.spark, path))
        return current_version(self.spark, path) is not None

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        if layer not in PLAIN:
            version = current_version(self.spark, path)
            if version is None:
                raise FileNotFoundError(f"{layer}.{table} has no committed version under {path}")
            path = version
            listed = bucket_list(self.spark, version)
            if listed:
                return self.spark.read.parquet(*listed["folders"].values())
        return self.spark.read.parquet(path)

    def loads(self, table: str) -> list[str]:
        """Ids of the finished loads of a bronze table, oldest first. A load that is being written is not among them."""
        path = self.path("bronze", table)
        folders = [n for n in files.child_names(self.spark, path) if n.startswith(f"{LOAD}=")]
        return [n[len(LOAD) + 1:] for n in folders if files.exists(self.spark, f"{path}/{n}/_SUCCESS")]

    def read_loads(self, table: str, loads: Sequence[str]) -> DataFrame:
        """The rows of some loads; the folders of all others are not even listed."""
        path = self.path("bronze", table)
        return self.spark.read.option("basePath", path).parquet(*[f"{path}/{LOAD}={n}" for n in loads])
