"""Generated day sequence."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default range of the date dimension.
DEFAULT_START = "2023-01-01"
DEFAULT_END = "2025-12-31"


def date_spine(spark: SparkSession, start: dt.date | str = DEFAULT_START, end: dt.date | str = DEFAULT_END) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))
