"""Keyed tables whose increments rewrite only the buckets they touch.

Rows lie in folders by a hash of their key. A new version is a list of folders: new ones for the touched
buckets, the old ones for all others. It counts once its list is written and marked, so a failed upsert
leaves the table as it was; folders that no kept version lists are removed afterwards.
"""

from __future__ import annotations

import json
import uuid
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import scratch
from tallyhouse.operators.keys import merged
from tallyhouse.sources import files
from tallyhouse.sources.tables import BUCKET_LIST, Lake, bucket_list, current_version, drop_old_versions, next_version

# A bucket is made for so many rows; beyond twice as many on average the table gets more buckets.
ROWS_PER_BUCKET = 2_000_000


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")


def _write(lake: Lake, folder: str, rows: DataFrame, key: str, buckets: int) -> tuple[dict[str, str], dict[str, int]]:
    """Write rows in new folders by bucket; returns folders and row counts."""
    to = f"{folder}/data/{uuid.uuid4().hex}"
    rows.withColumn("_bucket", _bucket(key, buckets)).hint("rebalance", "_bucket").write.option(*scratch.PACKED).partitionBy("_bucket").parquet(to)
    if not any(n.startswith("_bucket=") for n in files.child_names(lake.spark, to)):
        return {}, {}
    counts = {str(r["_bucket"]): r["count"] for r in lake.spark.read.parquet(to).groupBy("_bucket").count().collect()}
    return {b: f"{to}/_bucket={b}" for b in counts}, counts


def upsert_buckets(lake: Lake, layer: str, table: str, df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                   stored: bool = False) -> DataFrame:
    """Put rows into a table, replacing those with an equal key. ``df`` holds one row per key; ``stored``: it reads an intermediate table."""
    spark, folder = lake.spark, lake.path(layer, table)
    version = current_version(spark, folder)
    listed = bucket_list(spark, version) if version else None
    with scratch.scope(spark), scratch.partitions_for(spark, sum(listed["rows"].values()) if listed else 0):
        # Read for its buckets, its keys and its rows: stored, so that it is computed once.
        rows = df if stored else scratch.store(df, f"upsert-{table}")[0]
        size = rows.count()
        if listed is None:
            # The first version, or one that was published whole.
            whole = merged(lake.read(layer, table), rows, key) if version else rows
            buckets = max(1, ceil((size if not version else whole.count()) / rows_per_bucket))
            folders, counts = _write(lake, folder, whole, key, buckets)
        elif size == 0:
            return lake.read(layer, table)
        elif sum(listed["rows"].values()) + size > 2 * rows_per_bucket * listed["buckets"]:
            buckets = 4 * listed["buckets"]
            folders, counts = _write(lake, folder, merged(lake.read(layer, table), rows, key), key, buckets)
        else:
            buckets = listed["buckets"]
            touched = [str(r[0]) for r in rows.select(_bucket(key, buckets)).distinct().collect()]
            known = [listed["folders"][b] for b in touched if b in listed["folders"]]
            new = merged(spark.read.parquet(*known), rows, key) if known else rows
            folders, counts = _write(lake, folder, new, key, buckets)
            folders, counts = {**listed["folders"], **folders}, {**listed["rows"], **counts}
    if not folders:  # an empty table keeps its columns in a plain version
        df.limit(0).write.parquet(next_version(spark, folder))
    else:
        to = next_version(spark, folder)
        files.write_text(spark, f"{to}/{BUCKET_LIST}", json.dumps({"buckets": buckets, "folders": folders, "rows": counts}))
        files.write_text(spark, f"{to}/_SUCCESS", "")
    drop_old_versions(spark, folder)
    sweep(lake, layer, table)
    return lake.read(layer, table)


def sweep(lake: Lake, layer: str, table: str) -> None:
    """Remove bucket folders that no version lists any more."""
    spark, folder = lake.spark, lake.path(layer, table)
    used = set()
    for name in files.child_names(spark, folder):
        listed = bucket_list(spark, f"{folder}/{name}") if name.startswith("v=") else None
        used |= set(listed["folders"].values()) if listed else set()
    for batch in files.child_names(spark, f"{folder}/data"):
        for bucket in files.child_names(spark, f"{folder}/data/{batch}"):
            path = f"{folder}/data/{batch}/{bucket}"
            if bucket.startswith("_bucket=") and path not in used:
                files.delete(spark, path)
        if not any(u.startswith(f"{folder}/data/{batch}/") for u in used):
            files.delete(spark, f"{folder}/data/{batch}")
