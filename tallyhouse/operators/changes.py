"""Change sets beside a snapshot table.

A micro-batch writes only its own rows (``changes/<layer>.<table>/batch=<id>``, overwritten when the
batch is repeated). Readers see the newest change per key on top of the snapshot; ``compact`` folds the changes
into a new snapshot version now and then, instead of rewriting the table for every batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.keys import latest_per_key, merged
from tallyhouse.operators.publish import rebuild, upsert
from tallyhouse.sources import files
from tallyhouse.sources.tables import Lake

LAYER = "changes"
# Column of folded increments: the last batch they hold.
UPTO = "_upto"


def _folder(lake: Lake, layer: str, table: str) -> str:
    return lake.path(LAYER, f"{layer}.{table}")


def write_changes(lake: Lake, layer: str, table: str, df: DataFrame, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{_folder(lake, layer, table)}/batch={batch_id:012d}")


def _batches(lake: Lake, layer: str, table: str) -> list[str]:
    path = _folder(lake, layer, table)
    return [n for n in files.child_names(lake.spark, path)
            if n.startswith("batch=") and files.exists(lake.spark, f"{path}/{n}/_SUCCESS")]


def _read(lake: Lake, layer: str, table: str, batches: list[str], key: str) -> DataFrame:
    """Newest change per key over the given batches."""
    path = _folder(lake, layer, table)
    rows = lake.spark.read.option("basePath", path).parquet(*[f"{path}/{b}" for b in batches])
    return latest_per_key(rows, key, F.desc("batch")).drop("batch")


def current_rows(lake: Lake, layer: str, table: str, key: str) -> DataFrame:
    """Snapshot with the pending changes applied."""
    pending = _batches(lake, layer, table)
    if not pending:
        return lake.read(layer, table)
    changes = _read(lake, layer, table, pending, key)
    return merged(lake.read(layer, table), changes, key) if lake.has(layer, table) else changes


def compact(lake: Lake, layer: str, table: str, key: str) -> None:
    """Fold the pending changes into the snapshot, then remove them. Repeating it after a failure is harmless."""
    pending = _batches(lake, layer, table)
    if pending:
        upsert(lake, layer, table, _read(lake, layer, table, pending, key), key)
        for b in pending:
            files.delete(lake.spark, f"{_folder(lake, layer, table)}/{b}")


def _increments(lake: Lake, layer: str, table: str) -> tuple[DataFrame | None, list[str]]:
    """The folded rows, and the batches that are not in them yet."""
    folded = lake.read(layer, table) if lake.has(layer, table) else None
    upto = folded.agg(F.max(UPTO)).first()[0] if folded is not None else None
    pending = [b for b in _batches(lake, layer, table) if upto is None or int(b[6:]) > upto]
    return folded.drop(UPTO) if folded is not None else None, pending


def sum_of_changes(lake: Lake, layer: str, table: str, key: str) -> DataFrame:
    """Additive measures per key over all batches, for tables whose batches hold increments, not new values."""
    folded, pending = _increments(lake, layer, table)
    parts = [folded] if folded is not None else []
    if pending:
        parts.append(lake.spark.read.parquet(*[f"{_folder(lake, layer, table)}/{b}" for b in pending]))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    types = {f.name: f.dataType for f in rows.schema}
    return rows.groupBy(key).agg(*[F.sum(c).cast(types[c]).alias(c) for c in rows.columns if c != key])


def compact_sums(lake: Lake, layer: str, table: str, key: str) -> None:
    """Fold the pending increments into one table, then remove them.

    The table says up to which batch it goes, so batches that a failed run left behind are not added twice.
    """
    _, pending = _increments(lake, layer, table)
    if pending:
        rebuild(lake, layer, table, sum_of_changes(lake, layer, table, key).withColumn(UPTO, F.lit(int(pending[-1][6:])).cast("long")))
    for b in _batches(lake, layer, table):
        if not pending or b <= pending[-1]:
            files.delete(lake.spark, f"{_folder(lake, layer, table)}/{b}")
