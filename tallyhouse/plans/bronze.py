"""Raw files into append-only bronze tables, with a run log."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.operators.history import newer_rows, with_audit
from tallyhouse.operators.keys import without_known
from tallyhouse.operators.publish import append, counted_rows, rows_of
from tallyhouse.schemas import ENTITIES, RUN_LOG, Entity
from tallyhouse.sources import files
from tallyhouse.sources.csv_files import MALFORMED, malformed, scan_rows, well_formed
from tallyhouse.sources.tables import Lake

log = logging.getLogger(__name__)

RUN_TABLE = "pipeline_runs"
MODES = ("skip_existing", "append_all")
# Rows with more or fewer cells than their file's header, whole, with file and place.
MALFORMED_TABLE = "malformed_rows"


class LoadError(RuntimeError):
    pass


@dataclass(frozen=True)
class LoadResult:
    entity: str
    status: str
    rows_processed: int = 0
    rows_skipped: int = 0
    rows_malformed: int = 0
    error: str | None = None


def fresh_rows(incoming: DataFrame, lake: Lake, entity: Entity, mode: str) -> DataFrame:
    """Incoming rows to append: all, or those whose key is not in bronze yet.

    Repeats inside one file stay; silver keeps the last of them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "append_all" or not lake.has("bronze", entity.bronze_table):
        return incoming
    return without_known(incoming, lake.read("bronze", entity.bronze_table), entity.key)


def store_malformed(lake: Lake, entity: Entity, rows: DataFrame, mode: str) -> int:
    """Append the malformed rows of a scan; with known rows skipped, those that were stored before are not stored again."""
    bad = malformed(rows, entity)
    if mode == "skip_existing" and lake.has("bronze", MALFORMED_TABLE):
        known = lake.read("bronze", MALFORMED_TABLE).select("table", "_source_file", "record")
        bad = bad.join(known, ["table", "_source_file", "record"], "left_anti").select(*bad.columns)
    bad, written = counted_rows(bad, f"{entity.name}_malformed_{uuid.uuid4().hex}")
    append(lake, MALFORMED_TABLE, bad.withColumn("_ingested_at", F.current_timestamp()))
    return rows_of(written)


def load_bronze(lake: Lake, entity: Entity, path: str, mode: str = "skip_existing", max_malformed: int | None = None) -> LoadResult:
    """Append one entity's file(s). Counts come from the write itself; only files with malformed rows are read again.

    Malformed rows stay out of the table and go to a table of their own. With more than ``max_malformed`` of them
    nothing is appended and the load fails; the count then costs a scan before the load.
    """
    if not files.exists(lake.spark, path):
        return LoadResult(entity.name, "failed", error=f"File not found: {path}")
    scanned = scan_rows(lake.spark, entity, path)
    if max_malformed is not None:
        # Spark refuses to read nothing but the column of malformed rows.
        bad = scanned.agg(F.count(MALFORMED), F.max(entity.key)).first()[0]
        if bad > max_malformed:
            return LoadResult(entity.name, "failed", rows_malformed=bad, error=f"{bad} malformed rows in {path}")
    label = uuid.uuid4().hex
    seen = Observation(f"{entity.name}_read_{label}")
    observed = scanned.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed"))
    fresh, written = counted_rows(fresh_rows(well_formed(observed), lake, entity, mode), f"{entity.name}_new_{label}")
    append(lake, entity.bronze_table, fresh.withColumn("_ingested_at", F.current_timestamp()))
    total, bad, new = rows_of(seen), rows_of(seen, "malformed"), rows_of(written)
    if bad:
        log.warning("[%s] %d malformed rows, %d of them new", entity.name, bad, store_malformed(lake, entity, scanned, mode))
    log.info("[%s] %d new of %d rows", entity.name, new, total)
    return LoadResult(entity.name, "success", new, total - bad - new, bad)


def load_newer(lake: Lake, table: str, source: DataFrame, key: str, timestamp: str, lateness: str = "0 seconds") -> LoadResult:
    """Append the rows of a growing source table that bronze does not have yet, with audit columns.

    The mark of the last load is the latest timestamp in bronze itself; see ``operators.history.newer_rows``.
    """
    known = lake.read("bronze", table) if lake.has("bronze", table) else None
    fresh = source if known is None else newer_rows(source, known, timestamp, key, lateness)
    batch = uuid.uuid4().hex
    rows, written = counted_rows(with_audit(fresh, batch, source.columns), f"{table}_newer_{batch}")
    append(lake, table, rows.withColumn("_ingested_at", F.current_timestamp()))
    return LoadResult(table, "success", rows_of(written))


def log_run(lake: Lake, name: str, status: str, rows: int, started: dt.datetime, completed: dt.datetime,
            error: str | None = None) -> None:
    row = (uuid.uuid4().hex, name, started.date(), status, rows, started, completed, error)
    append(lake, RUN_TABLE, lake.spark.createDataFrame([row], RUN_LOG).coalesce(1))


def run_bronze(lake: Lake, folder: str, entities: Iterable[str] = tuple(ENTITIES), mode: str = "skip_existing",
               strict: bool = True, max_malformed: int | None = None) -> DataFrame:
    """Load every entity; one failure does not stop the others. Logs the run, then raises if any failed.

    The log names the entities with malformed rows, also of a run that succeeds.
    """
    started = dt.datetime.now()
    results = []
    for name in entities:
        entity = ENTITIES[name]
        try:
            results.append(load_bronze(lake, entity, f"{folder}/{entity.file}", mode, max_malformed))
        except Exception as exc:  # the other entities still load; reported and raised below
            log.exception("[%s] load failed", name)
            results.append(LoadResult(name, "failed", error=str(exc)))
    errors = [f"{r.entity}: {r.error}" for r in results if r.status == "failed"]
    notes = [f"{r.entity}: {r.rows_malformed} malformed rows stored apart" for r in results if r.status != "failed" and r.rows_malformed]
    log_run(lake, "bronze_loader", "failed" if errors else "success", sum(r.rows_processed for r in results),
            started, dt.datetime.now(), "; ".join(errors + notes) or None)
    if errors and strict:
        raise LoadError("; ".join(errors))
    return lake.spark.createDataFrame(
        [tuple(asdict(r).values()) for r in results],
        "entity string, status string, rows_processed long, rows_skipped long, rows_malformed long, error string")
