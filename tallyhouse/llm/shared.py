"""Tables between steps, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.operators import scratch


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table: what is read twice is computed once, and a lost executor costs no recomputation."""
    return scratch.store(df, label)[0]


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables once nothing reads them any more."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            scratch.discard(df.sparkSession, folder)
