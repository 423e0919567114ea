"""Invariants of the gold tables, their plans, and agreement with SQL."""

import time

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from checks.retail import AS_OF, END, START
from tallyhouse.operators import scratch
from tallyhouse.operators.publish import rebuild
from tallyhouse.plans import cohorts, dimensions, facts, marketing, reports, runs
from tests.conftest import SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_sales_add_up(retail):
    daily = marketing.daily_sales(retail.lines, retail.dates).agg(F.sum("gross_revenue"), F.sum("units_sold")).first()
    fact = retail.lines.filter("is_completed").agg(F.sum("gross_revenue"), F.sum("quantity")).first()
    assert tuple(daily) == tuple(fact)


def test_scores_split_evenly(retail):
    scored = retail.dim_customers.filter("recency_score IS NOT NULL")
    for score in ("recency_score", "frequency_score", "monetary_score"):
        sizes = [r["count"] for r in scored.groupBy(score).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_documented_recency_ranks_the_latest_highest(retail):
    best = retail.dim_customers.filter("recency_score = 5").agg(F.min("last_order_date")).first()[0]
    rest = retail.dim_customers.filter("recency_score < 5").agg(F.max("last_order_date")).first()[0]
    assert best >= rest
    with pytest.raises(ValueError):
        dimensions.rfm_scales("other")


def test_fact_keeps_every_line_with_its_parents(retail):
    assert retail.lines.count() == retail.items.count()
    assert retail.fact.columns[-3:] == ["gross_revenue", "cogs", "gross_profit"]


def test_dates_outside_the_spine_have_no_labels(spark, retail):
    short = dimensions.dim_date(spark, "1997-01-01", "1997-12-31", "1997-06-15")
    daily = marketing.daily_sales(retail.lines, short)
    assert daily.filter("month_name IS NULL").count() > 0
    assert daily.filter("year = 1997 AND month_name IS NULL").count() == 0
    assert daily.count() == marketing.daily_sales(retail.lines, retail.dates).count()


def test_filters_narrow_and_empty_means_all(retail):
    every = reports.kpis(retail.lines).first().total_orders
    assert reports.kpis(retail.lines, segments=[]).first().total_orders == every
    parts = [reports.kpis(retail.lines, segments=[s]).first().total_orders for s in reports.BOTH_SEGMENTS]
    assert sum(parts) == every
    assert reports.kpis(retail.lines, year=1066).first().total_orders == 0
    with pytest.raises(ValueError):
        reports.time_series(retail.lines, "hour")
    with pytest.raises(ValueError):
        reports.top_products(retail.dim_products, rank_by="1; drop table")


def test_matrix_fills_with_zero_and_curve_does_not(retail):
    long = cohorts.cohort_retention(retail.customers, retail.lines, since="1995-01-01")
    matrix = cohorts.cohort_matrix(long)
    assert matrix.columns == ["cohort"] + [f"Month {i}" for i in range(12)]
    assert matrix.filter(" OR ".join(f"`Month {i}` IS NULL" for i in range(12))).count() == 0
    first = long.filter("months_since_join = 0").agg(F.avg("retention_pct")).first()[0]
    assert abs(cohorts.retention_curve(long).filter("months_since_join = 0").first().retention_pct - first) < 0.001


def test_weighted_variants(retail):
    rfm = reports.rfm_segments(retail.dim_customers)
    weighted = {r.rfm_segment: r.avg_ltv for r in reports.rfm_by_segment(rfm, weighted=True).collect()}
    direct = {r.rfm_segment: r.v for r in retail.dim_customers.filter("completed_orders >= 1").groupBy("rfm_segment").agg(F.avg("lifetime_value").alias("v")).collect()}
    assert all(abs(weighted[k] - direct[k]) < 1 for k in direct)
    margin = reports.category_margin(retail.dim_products)
    assert reports.margin_by_category(margin, weighted=True).count() == reports.margin_by_category(margin).count()


def test_sample_is_bounded_and_from_the_list(retail):
    top = reports.top_ltv(retail.ltv)
    ids = {r.customer_id for r in top.collect()}
    sample = reports.ltv_sample(top, 30).collect()
    assert len(sample) == 30 and {r.customer_id for r in sample} <= ids


def test_padded_names(spark):
    row = dimensions.dim_date(spark, "2024-05-01", "2024-05-01", padded_names=True).first()
    assert row.month_name == "May      " and row.day_name == "Wednesday" and row.date_id == 20240501


# --- plans ----------------------------------------------------------------------------------------


def test_no_python_and_no_single_task_ranking(retail):
    for df in (retail.dim_customers, retail.dim_products, retail.fact, retail.ltv, retail.customer_orders):
        plan = plan_of(df)
        assert "EvalPython" not in plan and "SinglePartition" not in plan and "CartesianProduct" not in plan
        assert "NestedLoop" not in plan


def test_header_measures_do_not_read_lines(retail):
    scores = retail.customer_orders.select("customer_id", "total_revenue", "completed_orders", "last_order_date")
    assert "lineitem" not in plan_of(scores)


def test_reports_prune_the_published_fact(retail, lake):
    fact = rebuild(lake, "gold", "fact_orders", retail.lines, partition_by="order_month", sort_by="order_id")
    assert fact.count() == retail.lines.count()
    plan = plan_of(fact.filter("order_month = DATE '1997-03-01'").filter("is_completed").select("gross_revenue"))
    assert "PartitionFilters: [isnotnull(order_month" in plan and "item_id" not in plan
    assert "PushedFilters: [IsNotNull(is_completed), EqualTo(is_completed,true)]" in plan
    assert "PartitionFilters: [isnotnull(order_month" in plan_of(reports.kpis(fact, year=1997))
    assert "PartitionFilters: [isnotnull(order_month" in plan_of(cohorts.cohort_retention(retail.customers, fact, "1997-01-01"))
    months = reports.revenue_trend(fact, year=1997).select(F.year("month")).distinct().collect()
    assert [r[0] for r in months] == [1997]


def test_top_n_is_not_a_full_sort(retail):
    assert "TakeOrderedAndProject" in plan_of(reports.top_products(retail.dim_products))


def test_counts_do_not_expand_the_lines(retail):
    assert "Expand" not in plan_of(reports.revenue_trend(retail.lines)) and "Expand" not in plan_of(reports.kpis(retail.lines))


# --- SQL ------------------------------------------------------------------------------------------

NAMES = ["mdl5_int_customer_orders", "mdl6_int_product_metrics", "mdl8_dim_customers", "mdl9_dim_products_unmatched",
         "mdl11_daily_sales", "mdl12_customer_ltv", "ch2_cohort_activity", "rpt1_kpis_filtered", "rpt5_time_series_week",
         "rpt12_cohort_retention", "rpt28_category_tree", "slv3_clean_orders", "dq_report"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries

    assert compare(spark, connect(SF), SF, name, queries()[name], oracle_sql()[name]) is None


def test_entry_and_names(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())


def test_lines_are_moved_once(spark, retail):
    """Over lines stored by order, neither the product metrics nor the fact shuffles them."""
    with scratch.scope(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            items = scratch.store_by(retail.items, "order_id", "items")
            joined = items.join(retail.orders.select("order_id", "order_date", "is_completed"), "order_id")
            grouped = items.groupBy("order_id").count()
            assert plan_of(grouped).count("Exchange hashpartitioning") == 0
            assert plan_of(joined).count("Exchange hashpartitioning(order_id") == 1  # the headers
            assert joined.count() == retail.items.count()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_daily_sales_reads_the_fact_once(spark, retail, tmp_path):
    retail.lines.write.parquet(str(tmp_path / "fact"))
    daily = marketing.day_totals(spark.read.parquet(str(tmp_path / "fact")))
    assert plan_of(daily).count("FileScan parquet") == 1
    assert sorted(map(tuple, marketing.top_category(retail.lines).collect())) == sorted(map(tuple, daily.select("order_date", "top_category").collect()))


def test_narrow_lines_become_the_fact(retail):
    """A gold run moves lines into months without the columns that a day gives."""
    narrow = facts.narrow_lines(retail.items, retail.orders, retail.products, retail.dim_customers)
    assert not {*facts.DAY_COLUMNS, *facts.CALENDAR, "cogs", "gross_profit"} & set(narrow.columns)
    wide, fact = facts.widened(narrow, retail.dates), retail.fact
    assert wide.dtypes == fact.dtypes and wide.exceptAll(fact).count() == 0 and fact.exceptAll(wide).count() == 0


def test_shuffle_files_go_with_their_query(spark, retail, lake):
    """Neither gold runs nor published tables leave the files of their shuffles on the disks."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> int:
        return blocks.getAllFiles().mkString("|").count("/shuffle_")

    before = files()
    for table in ("customers", "products", "orders", "order_items"):
        rebuild(lake, "silver", table, getattr(retail.silver, table).repartition(3))
    runs.run_gold(lake, START, END, AS_OF)
    end = time.time() + 20
    while files() > before and time.time() < end:
        time.sleep(0.2)
    assert files() <= before
