"""The cleaning rules as SQL functions, for use in ``spark.sql``.

They are SQL functions over built-ins: Spark inlines them, no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyhouse.functions.parse import _NUMBER, DATE_FORMATS, STATUS_SYNONYMS
from tallyhouse.functions.text import EMAIL_SHAPE, WHITE_SPACE


def _raw(pattern: str) -> str:
    return f"r'{pattern}'"


def register(spark: SparkSession) -> None:
    """Create ``clean_email``, ``clean_numeric``, ``clean_date`` and ``standardize_status``."""
    strip = f"btrim({{0}}, '{WHITE_SPACE}')".format
    bare = strip("replace(x, ',', '')")
    dates = ", ".join(f"CASE WHEN {strip('x')} RLIKE {_raw(p)} THEN try_to_date({strip('x')}, '{f}') END" for p, f in DATE_FORMATS)
    status = f"lower({strip('x')})"
    synonyms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STATUS_SYNONYMS.items())
    bodies = {
        "clean_email(x STRING) RETURNS STRING":
            f"CASE WHEN lower({strip('x')}) RLIKE {_raw('(?U)' + EMAIL_SHAPE)} THEN lower({strip('x')}) END",
        "clean_numeric(x STRING) RETURNS DOUBLE":
            f"coalesce(CASE WHEN {bare} RLIKE {_raw(_NUMBER)} THEN try_cast(replace({bare}, '_', '') AS DOUBLE) END, 0D)",
        "clean_date(x STRING) RETURNS DATE": f"coalesce({dates})",
        "standardize_status(x STRING) RETURNS STRING": f"CASE {status} {synonyms} ELSE {status} END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
