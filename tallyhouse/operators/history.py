"""Row history: audit columns, timestamp-incremental reads, slowly changing rows (type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.publish import rebuild
from tallyhouse.sources.tables import Lake

HISTORY = "history"


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the values; a missing value differs from an empty one."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


def with_audit(df: DataFrame, batch_id: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({"_batch_id": F.lit(batch_id), "_file_row_hash": row_hash(columns), "_is_deleted": F.lit(False)})


def newer_rows(source: DataFrame, target: DataFrame, timestamp: str, key: str, lateness: str = "0 seconds") -> DataFrame:
    """Source rows not loaded so far; all rows for an empty target.

    Looks at rows from the latest loaded timestamp on, less the time rows may come late, and at rows
    without a timestamp, and leaves out keys the target has. Rows later than ``lateness`` are not seen.
    """
    last = target.agg(F.max(timestamp)).first()[0]
    if last is None:
        return source
    candidates = source.filter(F.col(timestamp).isNull() | (F.col(timestamp) >= F.lit(last) - F.expr(f"INTERVAL {lateness}")))
    return candidates.join(target.select(key), key, "left_anti")


def scd2_open(rows: DataFrame, tracked: Sequence[str], valid_from: Column) -> DataFrame:
    """Rows as the first version of themselves."""
    return rows.withColumns({
        "valid_from": valid_from, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True), "row_hash": row_hash(tracked)})


def publish_history(lake: Lake, table: str, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """A new version of the history table of an entity, with the changes of this snapshot; the first one opens it."""
    if lake.has(HISTORY, table):
        rows = scd2_apply(lake.read(HISTORY, table), snapshot, key, tracked, as_of)
    else:
        rows = scd2_open(snapshot, tracked, F.lit(as_of).cast("date"))
    return rebuild(lake, HISTORY, table, rows)


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """History after a new snapshot of the entity.

    A changed row closes its current version the day before and opens a new one; a version that opened
    on the same day or later is replaced, since it was never valid for a whole day. A new key opens a version;
    keys missing in the snapshot stay as they are. One join of the current versions with the snapshot
    decides both, and applying the same snapshot again changes nothing.
    """
    day = F.lit(as_of).cast("date")
    incoming = scd2_open(snapshot, tracked, day)
    current = history.filter("is_current").select(key, F.col("row_hash").alias("_known"))
    changed = incoming.join(current, key, "left").filter(F.col("_known").isNull() | (F.col("_known") != F.col("row_hash"))).drop("_known")
    ended = history.join(changed.select(key, F.lit(True).alias("_new")), key, "left")
    closing = F.col("is_current") & F.coalesce(F.col("_new"), F.lit(False))
    closed = ended.filter(~(closing & (F.col("valid_from") >= day))).withColumns({
        "valid_to": F.when(closing, F.date_sub(day, 1)).otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & ~closing}).drop("_new")
    return closed.unionByName(changed)


def as_of_join(facts: DataFrame, history: DataFrame, key: str, day: str, columns: dict[str, str]) -> DataFrame:
    """``facts`` with attributes of the version of their key that was valid on their day.

    ``columns`` maps attributes of the history to the names they get. Of several versions valid on a day the one opened last
    counts, and of those opened on one day the one that stays open or ends last. Attributes are NULL where no version was valid,
    where the key is unknown, and where key or day is NULL; no fact is lost or doubled.

    The versions of a key become one row with a list, so that this is an equi-join: it has no range condition to compare
    pairs by, and adaptive execution can split a key with very many facts, which a window by key could not. A list has at most one
    version a day of its key (``scd2_apply``).
    """
    far = F.lit("9999-12-31").cast("date")
    version = F.struct(F.col("valid_from").alias("opened"), F.coalesce("valid_to", far).alias("ended"), *[F.col(c).alias(f"a{i}") for i, c in enumerate(columns)])
    versions = history.filter(F.col("valid_from") <= F.coalesce("valid_to", far)).groupBy(F.col(key).alias("_key")).agg(F.collect_list(version).alias("_versions"))
    joined = facts.join(versions, F.col(key) == F.col("_key"), "left")

    def later(best: Column, v: Column) -> Column:
        valid = F.col(day).between(v["opened"], v["ended"])
        newer = best.isNull() | (F.struct(v["opened"], v["ended"]) > F.struct(best["opened"], best["ended"]))
        return F.when(valid & newer, v).otherwise(best)

    kind = history.select(version.alias("v")).schema["v"].dataType
    found = F.aggregate(F.coalesce("_versions", F.array().cast(f"array<{kind.simpleString()}>")), F.lit(None).cast(kind), later)
    out = joined.withColumn("_version", found)
    return out.select(*facts.columns, *[F.col(f"_version.a{i}").alias(n) for i, n in enumerate(columns.values())])
