"""Reports over the stored summaries: the same comparison SQL as over the fact."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import gold
from checks import sql as S
from checks.layers import new_lake
from checks.retail import Retail
from checks.sql import query
from tallyhouse.operators import scratch
from tallyhouse.plans import reports, summaries
from tallyhouse.sources.tables import Lake

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    """The stored fact, in the columns that summaries read."""
    r = Retail(spark, folder)
    with scratch.partitions_for(spark, r.silver.raw("lineitem").count()):
        return scratch.store(r.lines.select(*summaries.OF_FACT), "fact")[0]


@lru_cache(maxsize=4)
def _built(spark: SparkSession, folder: str) -> Lake:
    """Summaries of the fact over one folder of test tables, made once a session."""
    lake = new_lake(spark)
    summaries.refresh(lake, _fact(spark, folder))
    return lake


def add(name: str, build, like: str) -> None:
    QUERIES[f"sum_{name}"] = lambda spark, folder: build(summaries.Summaries(_built(spark, folder)))
    SQL[f"sum_{name}"] = gold.SQL[like]


add("rpt1_kpis", lambda s: reports.kpis(s), "rpt1_kpis")
add("rpt1_kpis_filtered", lambda s: reports.kpis(s, year=1997, segments=["B2B"]), "rpt1_kpis_filtered")
add("rpt2_revenue_trend", lambda s: reports.revenue_trend(s), "rpt2_revenue_trend")
add("rpt2_revenue_trend_filtered", lambda s: reports.revenue_trend(s, 1998, ["B2C"]), "rpt2_revenue_trend_filtered")
add("rpt3_category_breakdown", lambda s: reports.category_breakdown(s), "rpt3_category_breakdown")
add("rpt4_geo_sales", lambda s: reports.geo_sales(s), "rpt4_geo_sales")
for _grain in reports.GRAINS:
    add(f"rpt5_time_series_{_grain}", lambda s, g=_grain: reports.time_series(s, g), f"rpt5_time_series_{_grain}")
add("rpt6_order_status", lambda s: reports.order_status(s), "rpt6_order_status")
add("rpt7_shipping", lambda s: reports.shipping(s), "rpt7_shipping")
add("rpt8_weekday_revenue", lambda s: reports.weekday_revenue(s), "rpt8_weekday_revenue")


def _rerun(spark, folder) -> DataFrame:
    """Orders of every third customer come late: two months are refreshed once they are there; customers of all months."""
    lake, lines = new_lake(spark), _fact(spark, folder)
    late = (F.crc32(F.col("customer_id")) % 3 == 0) & F.col("order_month").isin(dt.date(1997, 3, 1), dt.date(1997, 4, 1))
    summaries.refresh(lake, lines.filter(~late))
    summaries.refresh(lake, lines, [dt.date(1997, 3, 1), dt.date(1997, 4, 1)])
    return reports.revenue_trend(summaries.Summaries(lake))


QUERIES["sum_rerun_months"] = _rerun
SQL["sum_rerun_months"] = query(S.SALES, gold._TREND + " GROUP BY 1, 2, 3")
