"""CSV scan that keeps every cell as text and every malformed row whole."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import Entity

log = logging.getLogger(__name__)


class SchemaError(ValueError):
    pass


def check_columns(found: list[str], expected, source: str) -> list[str]:
    """Raise on missing columns; return (and report) the extra ones."""
    missing = sorted(set(expected) - set(found))
    if missing:
        raise SchemaError(f"[{source}] Missing expected columns: {missing}")
    extra = sorted(set(found) - set(expected))
    if extra:
        log.warning("[%s] extra columns are ignored: %s", source, extra)
    return extra


def row_position():
    """Sortable position of a row in its source: file, then block, then order inside the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


#: The whole text of a row that has more or fewer cells than the header; NULL in all other rows.
MALFORMED = "_malformed"


def scan_rows(spark: SparkSession, entity: Entity, path: str) -> DataFrame:
    """Expected columns as text (an empty cell is "", never NULL), ``_row_id``, the file name, and ``_malformed``.

    Files split in parallel unless the entity needs quoted line breaks. ``enforceSchema`` is off so that a file
    whose header differs from the first one fails instead of shifting columns. All columns are parsed: with
    only some of them the parser would not see that a row has cells too many or too few.
    """
    options = {"header": True, "escape": '"', "enforceSchema": False, "multiLine": entity.multiline}
    header = spark.read.options(**options).csv(path).columns
    check_columns(header, entity.columns, entity.name)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
    raw = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, columnPruning=False).csv(path)
    return raw.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in entity.columns],
        row_position().alias("_row_id"),
        F.col("_metadata.file_name").alias("_source_file"),
        MALFORMED,
    )


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(rows: DataFrame, entity: Entity) -> DataFrame:
    """The malformed rows as they stand in their files: table, file, place in it, first cell, whole text."""
    bad = rows.filter(F.col(MALFORMED).isNotNull())
    return bad.select(F.lit(entity.name).alias("table"), "_source_file", "_row_id", F.col(entity.key).alias("key"), F.col(MALFORMED).alias("record"))


def scan_csv(spark: SparkSession, entity: Entity, path: str) -> DataFrame:
    """The well-formed rows of ``scan_rows``."""
    return well_formed(scan_rows(spark, entity, path))
