"""New files into bronze, and bronze into silver, as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators import scratch
from tallyhouse.operators.changes import compact, current_rows, write_changes
from tallyhouse.operators.keys import with_parent
from tallyhouse.operators.publish import append, upsert
from tallyhouse.plans.bronze import fresh_rows
from tallyhouse.plans.silver import MEASURES, REJECTED, last_written, new_rejects, orphan_rows, oversize_values
from tallyhouse.schemas import ENTITIES, Entity
from tallyhouse.sources import files
from tallyhouse.sources.tables import Lake


def stream_csv(lake: Lake, entity: Entity, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Arriving CSV files as text rows with their place in the source."""
    raw = (
        lake.spark.readStream.schema(entity.raw_schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return raw.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in entity.columns],
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_name").alias("_source_file"))


def stream_to_bronze(lake: Lake, entity: Entity, folder: str, checkpoint: str) -> StreamingQuery:
    """Append rows of files not seen before whose key is not in bronze yet; stops when caught up.

    A repeated batch finds its own keys in bronze and appends nothing.
    """
    def load(batch: DataFrame, _: int) -> None:
        # Row order can only be numbered inside the batch.
        placed = batch.withColumn("_row_id", F.struct(
            F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("seq")))
        fresh = fresh_rows(placed.drop("_file", "_block"), lake, entity, "skip_existing")
        append(lake, entity.bronze_table, fresh.withColumn("_ingested_at", F.current_timestamp()))

    return (
        stream_csv(lake, entity, folder).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_to_silver(lake: Lake, entity_name: str, clean: Callable[..., DataFrame], checkpoint: str, parents: Sequence[str] = ()) -> StreamingQuery:
    """Clean arriving bronze rows and write the last one per key as changes of the silver table.

    ``clean`` cleans without parents; rows whose key is missing in the current rows of a named silver parent are not
    lost: they wait in a table of their own and are tried again with every batch, and by ``load_waiting`` when only parents
    have arrived. A later row of a waiting key replaces it. Rows that break a rule do not wait, and numbers that do not fit
    go to the table of rejected values, as in a batch run.
    """
    entity = ENTITIES[entity_name]
    path = lake.path("bronze", entity.bronze_table)
    schema = lake.read("bronze", entity.bronze_table).schema

    def load(batch: DataFrame, batch_id: int) -> None:
        _load_silver(lake, entity, clean, parents, batch, batch_id)

    return (
        lake.spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _load_silver(lake: Lake, entity: Entity, clean: Callable[..., DataFrame], parents: Sequence[str], batch: DataFrame, batch_id: int) -> None:
    """Batches are numbered by the checkpoint; the waiting rows a batch starts from are those its predecessor left.

    Repeating a batch starts from the same waiting rows, since they are kept by batch number.
    """
    waiting = f"{lake.path('waiting', entity.name)}/batch="
    rows = batch
    earlier = [n for n in files.child_names(lake.spark, lake.path("waiting", entity.name)) if n.startswith("batch=") and int(n[6:]) < batch_id]
    if earlier:
        rows = rows.unionByName(lake.spark.read.schema(batch.schema).parquet(f"{lake.path('waiting', entity.name)}/{earlier[-1]}"))
    with scratch.scope(lake.spark):
        rows, _ = scratch.store(last_written(rows, entity.name), f"{entity.name}-batch")
        valid, _ = scratch.store(clean(rows), f"{entity.name}-valid")
        cleaned = valid
        for p in parents:
            cleaned = with_parent(cleaned, current_rows(lake, "silver", p, ENTITIES[p].key), ENTITIES[p].key).select(*valid.columns)
        if parents:
            cleaned, _ = scratch.store(cleaned, f"{entity.name}-clean")
        write_changes(lake, "silver", entity.name, cleaned, batch_id)
        if entity.name in MEASURES:
            rejects = new_rejects(lake, oversize_values(rows, entity.name))
            append(lake, REJECTED, rejects.withColumn("run_id", F.lit(f"batch {batch_id}")))
        if parents:
            orphan_rows(rows, valid, cleaned, entity.name, parents).write.mode("overwrite").parquet(f"{waiting}{batch_id:012d}")
            for n in earlier[:-1]:
                files.delete(lake.spark, f"{lake.path('waiting', entity.name)}/{n}")


def load_waiting(lake: Lake, entity_name: str, clean: Callable[..., DataFrame], parents: Sequence[str]) -> None:
    """Put waiting rows whose parents have arrived by now into silver.

    For the time between streams: it upserts into the snapshot, and rows it has put there stay in the waiting
    table until the next batch, where they are cleaned to the same silver rows.
    """
    entity = ENTITIES[entity_name]
    names = [n for n in files.child_names(lake.spark, lake.path("waiting", entity_name)) if n.startswith("batch=")]
    if not names:
        return
    compact(lake, "silver", entity_name, entity.key)
    schema = lake.read("bronze", entity.bronze_table).schema
    rows = lake.spark.read.schema(schema).parquet(f"{lake.path('waiting', entity_name)}/{names[-1]}")
    upsert(lake, "silver", entity_name, clean(rows, *[current_rows(lake, "silver", p, ENTITIES[p].key) for p in parents]), entity.key)
