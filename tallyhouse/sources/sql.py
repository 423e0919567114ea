"""Ad-hoc SQL over named relations."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None, **relations: DataFrame) -> DataFrame:
    """Run a query with bound parameters (``:name``) over relations given by name (``{name}``).

    Values are bound, never spliced into the text.
    """
    return spark.sql(query, args=args or {}, **relations)
