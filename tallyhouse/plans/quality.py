"""Data-quality checks: failing rows, one report, a gate."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.dates import as_date
from tallyhouse.operators.keys import orphans
from tallyhouse.operators.publish import rebuild
from tallyhouse.schemas import CUSTOMER_SEGMENTS, MAX_LENGTHS, ORDER_STATUSES
from tallyhouse.sources.tables import Lake

Tables = Mapping[str, DataFrame]


class QualityError(RuntimeError):
    pass


@dataclass(frozen=True)
class Check:
    """``bad_row`` marks failing rows of the table; ``rows`` computes them when it takes more than one row."""

    kind: str
    table: str
    column: str
    bad_row: Column | None = None
    rows: Callable[[Tables], DataFrame] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"

    def failing(self, tables: Tables) -> DataFrame:
        return self.rows(tables) if self.rows else tables[self.table].filter(self.bad_row)


def unique(table: str, column: str) -> Check:
    """Failing rows are the repeated keys. NULLs do not count."""
    def rows(t: Tables) -> DataFrame:
        counts = t[table].filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
        return counts.filter("copies > 1")
    return Check("unique", table, column, rows=rows)


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column, F.col(column).isNull())


def accepted(table: str, column: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", table, column, F.coalesce(~F.col(column).isin(*values), F.lit(False)))


def refers_to(table: str, column: str, parent: str) -> Check:
    return Check("relationships", table, column, rows=lambda t: orphans(t[table], t[parent], column))


def max_length(table: str, column: str, limit: int) -> Check:
    return Check("max_length", table, column, F.coalesce(F.length(column) > limit, F.lit(False)))


def row_rule(kind: str, table: str, column: str, bad: Column) -> Check:
    return Check(kind, table, column, F.coalesce(bad, F.lit(False)))


def table_checks() -> list[Check]:
    """Keys, required columns, domains and references of the staged tables."""
    required = {
        "customers": ("customer_id", "registration_date"),
        "orders": ("order_id", "customer_id", "total_amount", "order_date"),
        "products": ("product_id", "category", "selling_price"),
        "order_items": ("item_id", "order_id", "product_id", "quantity", "unit_price"),
    }
    return [
        *[unique(t, columns[0]) for t, columns in required.items()],
        *[not_null(t, c) for t, columns in required.items() for c in columns],
        accepted("customers", "customer_segment", CUSTOMER_SEGMENTS),
        accepted("orders", "order_status", ORDER_STATUSES),
        refers_to("orders", "customer_id", "customers"),
        refers_to("order_items", "order_id", "orders"),
        refers_to("order_items", "product_id", "products"),
    ]


def gate_checks(as_of=None) -> list[Check]:
    """The checks that must hold before gold is built."""
    return [
        unique("customers", "customer_id"),
        row_rule("no_negative", "orders", "total_amount", F.col("total_amount") < 0),
        row_rule("no_future", "orders", "order_date", F.col("order_date") > as_date(as_of)),
        refers_to("orders", "customer_id", "customers"),
        refers_to("order_items", "product_id", "products"),
    ]


def length_checks() -> list[Check]:
    tables = {"customer_segment": "customers", "order_status": "orders"}
    return [max_length(tables[c], c, n) for c, n in MAX_LENGTHS.items()]


def report(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """(check, table, column, failing_rows, status) for all checks.

    All row-level checks of a table share one pass over it.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        simple = [c for c in checks if c.table == table and c.rows is None]
        if simple:
            counts = tables[table].agg(*[F.count_if(c.bad_row).alias(f"n{i}") for i, c in enumerate(simple)])
            entries = [F.struct(F.lit(c.name).alias("check"), F.lit(table).alias("table"), F.lit(c.column).alias("column"),
                                F.col(f"n{i}").alias("failing_rows")) for i, c in enumerate(simple)]
            parts.append(counts.select(F.inline(F.array(*entries))))
    for c in checks:
        if c.rows is not None:
            parts.append(c.rows(tables).agg(F.count(F.lit(1)).alias("failing_rows")).select(
                F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), F.lit(c.column).alias("column"), "failing_rows"))
    merged = reduce(DataFrame.unionByName, parts)
    return merged.withColumn("status", F.when(F.col("failing_rows") == 0, "pass").otherwise("fail"))


def store_failures(lake: Lake, tables: Tables, checks: Sequence[Check], failed: Sequence[str]) -> list[str]:
    """Write the failing rows of each failed check as a table of the ``dq_failures`` layer."""
    done = []
    for c in checks:
        if c.name in failed and c.name not in done:
            rebuild(lake, "dq_failures", re.sub(r"\W", "_", c.name), c.failing(tables))
            done.append(c.name)
    return done


def run_quality(lake: Lake, tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """Evaluate every check, store the failing rows, raise once if any failed; else return the report."""
    done = report(tables, checks)
    rows = done.collect()  # one row per check
    failed = [r["check"] for r in rows if r["status"] == "fail"]
    if failed:
        store_failures(lake, tables, checks, failed)
        raise QualityError("; ".join(f"{r['check']}: {r['failing_rows']} rows" for r in rows if r["status"] == "fail"))
    return lake.spark.createDataFrame(rows, done.schema)
