"""Sales summaries: plans that read no order, months that are replaced alone, numbers that stay."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import scratch
from tallyhouse.plans import reports, summaries
from tallyhouse.sources import files
from tallyhouse.sources.tables import SUMMARIES

MARCH, APRIL = dt.date(1997, 3, 1), dt.date(1997, 4, 1)


def files_by_month(spark, lake):
    """Part files of every summary table's months."""
    return {
        (table, month): files.child_names(spark, f"{lake.path(SUMMARIES, table)}/{month}")
        for table in (summaries.DAYS, summaries.CATEGORIES, summaries.DAY_CUSTOMERS, summaries.WEEK_SETS, summaries.MONTH_SETS)
        for month in files.child_names(spark, lake.path(SUMMARIES, table)) if month.startswith("order_month=")
    }


@pytest.fixture
def lines(retail):
    return scratch.store(retail.lines, "fact")[0]


REPORTS = [
    lambda f: reports.kpis(f, 1997, ["B2C"]), lambda f: reports.revenue_trend(f, 1996), lambda f: reports.category_breakdown(f, 1995, ["B2B"]),
    lambda f: reports.geo_sales(f, 1997), lambda f: reports.time_series(f, "week", 1997, ["B2C"]), lambda f: reports.time_series(f, "day", 1998),
    lambda f: reports.order_status(f, 1996), lambda f: reports.shipping(f, 1997), lambda f: reports.weekday_revenue(f, 1998),
    lambda f: reports.kpis(f, 1950), lambda f: reports.revenue_trend(f, 1950),
]


def test_filtered_reports_equal_those_of_the_fact(lake, lines):
    """Years and segments, and attributes that are NULL for some customers, methods and days."""
    odd = F.crc32("customer_id") % 7 == 0
    lines = lines.withColumns({
        "customer_segment": F.when(~odd, F.col("customer_segment")), "customer_state": F.when(F.crc32("customer_id") % 5 != 0, F.col("customer_state")),
        "shipping_method": F.when(F.crc32("order_id") % 6 != 0, F.col("shipping_method")),
        "days_to_ship": F.when(F.crc32("order_id") % 4 != 0, F.col("days_to_ship")),
        "customer_id": F.when(F.crc32("customer_id") % 11 != 0, F.col("customer_id")),
    })
    summaries.refresh(lake, lines)
    stored = summaries.Summaries(lake)
    for i, report in enumerate(REPORTS):
        assert report(stored).collect() == report(lines).collect(), i


def test_a_rerun_month_replaces_only_its_own_files(spark, lake, lines):
    late = (F.crc32("customer_id") % 2 == 0) & F.col("order_month").isin(MARCH, APRIL)
    summaries.refresh(lake, lines.filter(~late).filter(F.col("order_month") != APRIL))
    before, numbers = files_by_month(spark, lake), {r.customer_id: r.number for r in lake.read(SUMMARIES, summaries.NUMBERS).collect()}
    summaries.refresh(lake, lines, [MARCH, APRIL])
    after = files_by_month(spark, lake)
    assert {m for (t, m), names in after.items() if before.get((t, m)) != names} == {"order_month=1997-03-01", "order_month=1997-04-01"}
    again = {r.customer_id: r.number for r in lake.read(SUMMARIES, summaries.NUMBERS).collect()}
    assert {c: again[c] for c in numbers} == numbers and sorted(again.values()) == list(range(1, len(again) + 1))
    assert reports.time_series(summaries.Summaries(lake), "month").collect() == reports.time_series(lines, "month").collect()
    # A month that has no rows any more goes.
    summaries.refresh(lake, lines.filter(F.col("order_month") != MARCH), [MARCH])
    assert {m for _, m in after} - {m for _, m in files_by_month(spark, lake)} == {"order_month=1997-03-01"}


def test_reports_move_no_row_per_order(lake, lines):
    summaries.refresh(lake, lines)
    stored = summaries.Summaries(lake)
    for report in REPORTS:
        df = report(stored)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "order_id" not in plan and all(f"/{SUMMARIES}/" in f for f in df.inputFiles())
    trend = reports.revenue_trend(stored, 1997)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*order_month", trend)) == 2  # only the year's partitions are read


def test_empty_fact(lake, lines):
    summaries.refresh(lake, lines.limit(0))
    assert reports.revenue_trend(summaries.Summaries(lake)).collect() == []
