"""Gold after small changes: equal to a full rebuild, with only the touched months written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.retail import AS_OF, END, START
from tallyhouse.operators.publish import rebuild
from tallyhouse.plans import refresh, reports, runs, summaries
from tallyhouse.sources import files
from tallyhouse.sources.star_adapter import StarTables
from tallyhouse.sources.tables import Lake, current_version
from tests.conftest import SF

TABLES = ("customers", "products", "orders", "order_items")
FIRST, SECOND, THIRD = (dt.datetime(2002, 1, d) for d in (1, 2, 3))


def stamped(df, when):
    return df.withColumn("_updated_at", F.lit(when).cast("timestamp"))


def changed(df, where, when, **columns):
    """The table with some rows changed and stamped."""
    return df.withColumns({c: F.when(where, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in {**columns, "_updated_at": F.lit(when)}.items()})


def month_files(spark, lake):
    path = current_version(spark, lake.path("gold", "fact_orders"))
    return {m: files.child_names(spark, f"{path}/{m}") for m in files.child_names(spark, path) if m.startswith("order_month=")}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def base(spark):
    star = StarTables(spark, SF)
    return {t: stamped(getattr(star, t), FIRST) for t in TABLES}


def put(lake, tables):
    for t, df in tables.items():
        rebuild(lake, "silver", t, df)


def check_against_rebuild(spark, lake, tmp_path, tables):
    full = Lake(spark, str(tmp_path / "full"))
    put(full, tables)
    runs.run_gold(full, START, END, AS_OF)
    for t in runs.GOLD_TABLES:
        assert rows(lake.read("gold", t)) == rows(full.read("gold", t)), t
    fact = full.read("gold", "fact_orders")
    assert reports.revenue_trend(summaries.Summaries(lake)).collect() == reports.revenue_trend(fact).collect()
    assert reports.category_breakdown(summaries.Summaries(lake)).collect() == reports.category_breakdown(fact).collect()


def test_only_touched_months_are_written(spark, lake, tmp_path, base):
    put(lake, base)
    assert refresh.refresh_gold(lake, START, END, AS_OF) is None
    before = month_files(spark, lake)
    assert refresh.refresh_gold(lake, START, END, AS_OF) == [] and month_files(spark, lake) == before

    # Lines of one order, an order that moves to another month, a new line, a new order of a new product.
    fact = lake.read("gold", "fact_orders")
    by_month = {r.order_month: r.order_id for r in fact.filter("NOT is_completed").groupBy("order_month").agg(F.min("order_id").alias("order_id")).collect()}
    (m1, o1), (m2, o2) = sorted(by_month.items())[:2]
    template = base["order_items"].filter(F.col("order_id") == o2).limit(1)
    product = base["products"].limit(1).withColumns({"product_id": F.lit("PROD-new"), "category": F.lit("New")})
    line = template.withColumns({"item_id": F.lit("ITEM-new"), "product_id": F.lit("PROD-new")})
    tables = {
        **base,
        "products": base["products"].unionByName(stamped(product, SECOND)),
        "orders": changed(base["orders"], F.col("order_id") == o1, SECOND, order_date=F.lit("2001-11-11")),
        "order_items": changed(base["order_items"], F.col("order_id") == o2, SECOND, quantity=F.lit(3)).unionByName(stamped(line, SECOND)),
    }
    put(lake, tables)
    months = refresh.refresh_gold(lake, START, END, AS_OF)
    assert set(months) == {m1, m2, dt.date(2001, 11, 1)}
    after = month_files(spark, lake)
    assert {m for m in after.keys() | before.keys() if after.get(m) != before.get(m)} == {f"order_month={m}" for m in months}
    check_against_rebuild(spark, lake, tmp_path, tables)


def test_a_customer_and_a_product(spark, lake, tmp_path, base):
    """Another segment and another cost reach all lines of the customer and the product, and no other month."""
    put(lake, base)
    refresh.refresh_gold(lake, START, END, AS_OF)
    before, fact = month_files(spark, lake), lake.read("gold", "fact_orders")
    customer = fact.groupBy("customer_id").agg(F.countDistinct("order_month").alias("n")).orderBy("n", "customer_id").first()[0]
    product = fact.groupBy("product_id").agg(F.countDistinct("order_month").alias("n")).orderBy("n", "product_id").first()[0]
    tables = {
        **base,
        "customers": changed(base["customers"], F.col("customer_id") == customer, THIRD, customer_segment=F.lit("B2X")),
        "products": changed(base["products"], F.col("product_id") == product, THIRD, cost_price=F.lit(0.01)),
    }
    hit = fact.filter((F.col("customer_id") == customer) | (F.col("product_id") == product)).select("order_month").distinct().collect()
    put(lake, tables)
    months = refresh.refresh_gold(lake, START, END, AS_OF)
    assert set(months) == {r[0] for r in hit} and 0 < len(months) < len(before)
    after = month_files(spark, lake)
    assert {m for m in after if after[m] != before.get(m)} == {f"order_month={m}" for m in months}
    check_against_rebuild(spark, lake, tmp_path, tables)
