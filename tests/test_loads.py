"""Small hand-checked files through bronze and silver, the checks, and the streaming forms."""

import datetime as dt
from decimal import Decimal

import pytest

from tallyhouse.operators import scratch
from tallyhouse.operators.changes import compact, current_rows
from tallyhouse.operators.publish import rebuild
from tallyhouse.plans import bronze, quality, reports, runs, silver
from tallyhouse.schemas import ENTITIES, SILVER
from tallyhouse.sources.csv_files import SchemaError, check_columns, scan_csv
from tallyhouse.sources.sql import run_sql
from tallyhouse.sources.tables import Lake
from tallyhouse.streaming import ingest

FILES = {
    "customers": '''customer_id,first_name,last_name,email,phone,city,state,country,zip_code,customer_segment,registration_date
CUST-1, o'neil ,mc-donald,USER@EXAMPLE.COM,1,Rome,ca,us,00001,b2c,2023-01-05
CUST-2,ann,lee,not-an-email,2,"Paris, TX",ny ,us,2,B2B,01/07/2023
CUST-1,bob,ray,b@x.io,3,Rome,ca,us,1,B2C,2023-02-01
X-9,no,prefix,a@b.co,4,Rome,ca,us,1,B2C,2023-02-01
CUST-3,,,c@d.ef,5,"say ""hi""",tx,us,3,b2b,never
''',
    "products": '''product_id,product_name,category,subcategory,brand,cost_price,selling_price,stock_quantity,sku
P1, Lamp ,home & kitchen,Light, Acme,10,"1,020.50",5,S1
P2,Book,books,Fiction,Foo,20,10,5,S2
P3,Pen,office supplies,,Foo,0,0,5,S3
P4,Mug,home,,Foo,x,2.5,12.9,S4
''',
    "orders": '''order_id,customer_id,order_date,ship_date,shipping_method,order_status,total_amount,discount_code
O1,CUST-1,2023-03-01,2023-03-04,Express,Done,"1,020.50", SAVE10
O2,CUST-2,03/02/2023,,Standard,CANCELED,30,
O3,CUST-9,2023-03-03,,Standard,complete,10,
O4,CUST-1,2023-02-30,,Standard,complete,10,
O5,CUST-1,2023/03/05,,Standard,complete,-1,
O6,CUST-2,05-03-2023,2023-03-05,Overnight,in_transit,n/a,VIP25
''',
    "order_items": '''item_id,order_id,product_id,quantity,unit_price,discount_pct
I1,O1,P1,2.9,"1,020.50",50
I2,O1,P2,1,10,0
I3,O9,P1,1,10,0
I4,O2,P4,0,2.555,150
I5,O6,P4,x,2.50,-5
''',
    "events": '''event_id,customer_id,event_type,product_id,event_timestamp,session_id,device_type
E1,CUST-1,page_view,P1,2023-03-01 10:00:00,SESS-1,mobile
''',
}


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "files"
    path.mkdir()
    for name, text in FILES.items():
        (path / f"{name}.csv").write_text(text)
    return path


def test_config_is_complete():
    assert list(ENTITIES) == ["customers", "products", "orders", "order_items", "events"]
    for e in ENTITIES.values():
        assert e.key == e.columns[0] and e.file.endswith(".csv") and e.bronze_table == f"raw_{e.name}"
        assert all(f.dataType.simpleString() == "string" for f in e.raw_schema)


def test_check_columns(caplog):
    assert check_columns(["a", "b"], ["a", "b"], "x") == []
    with pytest.raises(SchemaError, match="Missing expected columns"):
        check_columns(["a"], ["a", "b"], "x")
    assert check_columns(["a", "z"], ["a"], "x") == ["z"] and "z" in caplog.text


def test_scan_keeps_text_and_empties(spark, folder):
    rows = {r.customer_id: r for r in scan_csv(spark, ENTITIES["customers"], str(folder / "customers.csv")).collect()}
    assert rows["CUST-3"].first_name == "" and rows["CUST-3"].city == 'say "hi"' and rows["CUST-2"].city == "Paris, TX"
    assert rows["CUST-2"].state == "ny " and rows["CUST-2"]._source_file == "customers.csv"


def test_scan_drops_extra_and_reorders(spark, tmp_path):
    (tmp_path / "e.csv").write_text("extra,item_id,product_id,order_id,quantity,unit_price,discount_pct\nz,I,P,O,1,2,3\n")
    row = scan_csv(spark, ENTITIES["order_items"], str(tmp_path / "e.csv")).drop("_row_id", "_source_file").first()
    assert tuple(row) == ("I", "O", "P", "1", "2", "3")


UNEVEN = '''item_id,order_id,product_id,quantity,unit_price,discount_pct
I1,O1,P1,1,"1,0",5
I2,O1,P1,1,2,3,4,"five, six"
I3,O1

"I4",O2,P2,,"say ""hi""",
I5,O1,P1,1,2
I6,,,,,
'''


def test_malformed_rows_are_kept_whole(spark, lake, tmp_path):
    (tmp_path / "order_items.csv").write_text(UNEVEN)
    entity, path = ENTITIES["order_items"], str(tmp_path / "order_items.csv")
    first = bronze.load_bronze(lake, entity, path)
    assert (first.rows_processed, first.rows_skipped, first.rows_malformed) == (3, 0, 3)
    good = {r.item_id: (r.quantity, r.unit_price, r.discount_pct) for r in lake.read("bronze", "raw_order_items").collect()}
    assert good == {"I1": ("1", "1,0", "5"), "I4": ("", 'say "hi"', ""), "I6": ("", "", "")}
    bad = lake.read("bronze", bronze.MALFORMED_TABLE).orderBy("_row_id").collect()
    assert [(r.table, r._source_file, r.key, r.record) for r in bad] == [
        ("order_items", "order_items.csv", "I2", 'I2,O1,P1,1,2,3,4,"five, six"'), ("order_items", "order_items.csv", "I3", "I3,O1"),
        ("order_items", "order_items.csv", "I5", "I5,O1,P1,1,2")]
    again = bronze.load_bronze(lake, entity, path)
    assert (again.rows_processed, again.rows_skipped, again.rows_malformed) == (0, 3, 3)
    assert lake.read("bronze", bronze.MALFORMED_TABLE).count() == 3  # known rows are not stored again
    bronze.load_bronze(lake, entity, path, mode="append_all")
    assert lake.read("bronze", bronze.MALFORMED_TABLE).count() == 6


def test_too_many_malformed_rows_fail(spark, lake, tmp_path):
    (tmp_path / "order_items.csv").write_text(UNEVEN)
    entity, path = ENTITIES["order_items"], str(tmp_path / "order_items.csv")
    strict = bronze.load_bronze(lake, entity, path, max_malformed=2)
    assert strict.status == "failed" and strict.rows_malformed == 3 and not lake.has("bronze", "raw_order_items")
    assert bronze.load_bronze(lake, entity, path, max_malformed=3).rows_processed == 3
    bronze.run_bronze(lake, str(tmp_path), ["order_items"])
    logged = lake.read("bronze", bronze.RUN_TABLE).first()
    assert logged.status == "success" and logged.error_message == "order_items: 3 malformed rows stored apart"


def test_multiline_files_have_malformed_rows_too(spark, tmp_path):
    import dataclasses

    from tallyhouse.sources.csv_files import malformed, scan_rows

    entity = dataclasses.replace(ENTITIES["events"], multiline=True)
    head = ",".join(entity.columns)
    (tmp_path / "e.csv").write_text(f'{head}\nE1,C,t,P,"a\nb",S,d\nE2,C,t\n')
    rows = scan_rows(spark, entity, str(tmp_path / "e.csv"))
    assert [r.event_timestamp for r in scan_csv(spark, entity, str(tmp_path / "e.csv")).collect()] == ["a\nb"]
    assert [r.record.strip() for r in malformed(rows, entity).collect()] == ["E2,C,t"]


def test_bronze_skips_known_keys_but_not_repeats_in_a_file(spark, lake, folder):
    path = str(folder / "customers.csv")
    first = bronze.load_bronze(lake, ENTITIES["customers"], path)
    again = bronze.load_bronze(lake, ENTITIES["customers"], path)
    assert (first.rows_processed, first.rows_skipped, again.rows_processed, again.rows_skipped) == (5, 0, 0, 5)
    everything = bronze.load_bronze(lake, ENTITIES["customers"], path, mode="append_all")
    assert everything.rows_processed == 5 and lake.read("bronze", "raw_customers").count() == 10


def test_bronze_run_reports_and_raises(spark, lake, folder):
    (folder / "orders.csv").unlink()
    (folder / "events.csv").write_text("event_id\nE1\n")
    with pytest.raises(bronze.LoadError, match="File not found"):
        bronze.run_bronze(lake, str(folder))
    logged = lake.read("bronze", bronze.RUN_TABLE).first()
    assert logged.status == "failed" and logged.rows_processed == 14
    assert "orders: File not found" in logged.error_message and "Missing expected columns" in logged.error_message
    assert reports.freshness(lake.read("bronze", bronze.RUN_TABLE)).first().last_run is None


def test_silver_tables(spark, lake, folder):
    bronze.run_bronze(lake, str(folder))
    stats = {r.table: (r.candidates, r.written, r.dropped) for r in silver.run_silver(lake).collect()}
    assert stats == {"customers": (4, 3, 1), "products": (4, 2, 2), "orders": (6, 3, 3), "order_items": (5, 3, 2)}
    for table, schema in SILVER.items():
        assert [(f.name, f.dataType) for f in lake.read("silver", table).schema] == [(f.name, f.dataType) for f in schema]
    c = {r.customer_id: r for r in lake.read("silver", "customers").collect()}
    assert c["CUST-1"].full_name == "Bob Ray" and c["CUST-1"].registration_date == dt.date(2023, 2, 1)  # the last row in the file
    assert c["CUST-2"].email is None and c["CUST-2"].state == "NY" and c["CUST-2"].registration_date == dt.date(2023, 1, 7)
    assert c["CUST-3"].full_name == " " and c["CUST-3"].customer_segment == "B2B" and c["CUST-3"].registration_date is None
    p = {r.product_id: r for r in lake.read("silver", "products").collect()}
    assert p["P1"].selling_price == Decimal("1020.50") and p["P1"].category == "Home & Kitchen" and p["P1"].brand == "Acme"
    assert p["P4"].cost_price == 0 and p["P4"].margin_pct == 100 and p["P4"].stock_quantity == 12
    o = {r.order_id: r for r in lake.read("silver", "orders").collect()}
    assert o["O1"].order_status == "completed" and o["O1"].days_to_ship == 3 and o["O1"].total_amount == Decimal("1020.50")
    assert o["O2"].order_status == "cancelled" and o["O2"].order_date == dt.date(2023, 3, 2) and o["O2"].days_to_ship is None
    assert o["O6"].order_status == "shipped" and o["O6"].total_amount == 0 and o["O6"].order_date == dt.date(2023, 3, 5)
    i = {r.item_id: r for r in lake.read("silver", "order_items").collect()}
    assert (i["I1"].quantity, i["I1"].line_total) == (2, Decimal("1020.50"))
    assert (i["I4"].quantity, i["I4"].unit_price, i["I4"].discount_pct, i["I4"].line_total) == (1, Decimal("2.56"), 100, 0)
    assert (i["I5"].quantity, i["I5"].discount_pct, i["I5"].line_total) == (1, 0, Decimal("2.50"))


def test_second_silver_run_changes_nothing(spark, lake, folder):
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    before = {t: sorted(map(tuple, lake.read("silver", t).drop("_updated_at").collect()), key=str) for t in SILVER}
    silver.run_silver(lake)
    assert before == {t: sorted(map(tuple, lake.read("silver", t).drop("_updated_at").collect()), key=str) for t in SILVER}


def test_full_run_and_views(spark, lake, folder):
    text = FILES["customers"].replace("never", "2023-01-01").replace("X-9,no,prefix", "CUST-4,no,orders")
    (folder / "customers.csv").write_text(text)
    runs.run_all(lake, str(folder), as_of="2023-12-31")
    for table in runs.GOLD_TABLES:
        assert lake.has("gold", table)
    assert lake.read("gold", "dim_date").count() == 1096
    fact = {r.item_id: r for r in lake.read("gold", "fact_orders").collect()}
    assert len(fact) == 3 and fact["I1"].discount_code == "SAVE10" and fact["I1"].gross_profit == Decimal("1000.50")
    customers = {r.customer_id: r for r in lake.read("gold", "dim_customers").collect()}
    assert customers["CUST-4"].rfm_segment == "No Orders" and customers["CUST-4"].customer_tier == "Inactive"
    assert customers["CUST-1"].customer_tier == "Gold" and customers["CUST-1"].recency_score == 2
    ltv = {r.customer_id: r for r in lake.read("gold", "customer_ltv").collect()}
    assert ltv["CUST-1"].churn_status == "At Risk of Churn" and ltv["CUST-2"].churn_status == "Never Purchased"
    daily = lake.read("gold", "daily_sales").collect()
    assert [(r.order_date, r.gross_revenue, r.b2b_revenue, r.top_category) for r in daily] == [
        (dt.date(2023, 3, 1), Decimal("1020.50"), None, "Home & Kitchen")]
    runs.create_views(lake)
    n = run_sql(spark, "SELECT count(*) AS n FROM stg_orders WHERE order_status = :s", {"s": "completed"}).first().n
    assert n == 1 and spark.table("int_product_metrics").count() == 2
    log = lake.read("bronze", bronze.RUN_TABLE)
    assert sorted(r.pipeline_name for r in log.collect()) == [
        "bronze_loader", "full_run", "gold", "quality_gate", "silver", "table_checks"]
    assert reports.freshness(log).first().last_run is not None


def test_empty_file_loads_nothing(spark, lake, folder):
    path = folder / "orders.csv"
    bronze.load_bronze(lake, ENTITIES["orders"], str(path))
    path.write_text(FILES["orders"].splitlines()[0] + "\n")
    again = bronze.load_bronze(lake, ENTITIES["orders"], str(path))
    assert (again.status, again.rows_processed, again.rows_skipped) == ("success", 0, 0)
    assert lake.read("bronze", "raw_orders").count() == 6


def test_updates_reach_silver_when_their_parent_is_late(spark, lake):
    """An order and a line that silver has move to a customer and a product that come later; stamps may be missing or old."""
    from pyspark.sql import functions as F

    from tallyhouse.operators.publish import append

    def deliver(name, day, *rows):
        entity = ENTITIES[name]
        df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in entity.columns) + ", _row_id long")
        append(lake, entity.bronze_table, df.withColumn("_ingested_at", F.lit(None if day is None else dt.datetime(2024, 2, day)).cast("timestamp")))

    def customer(key):
        return (key, "ann", "lee", "a@b.co", "1", "Rome", "ca", "us", "1", "B2B", "2023-01-05")

    def order(key, parent):
        return (key, parent, "2023-03-01", "", "Express", "Done", "10", "")

    def silver_rows(table, *columns):
        return {tuple(r) for r in lake.read("silver", table).select(*columns).collect()}

    product = ("Lamp", "home", "Light", "Acme", "1", "2", "5", "S1")
    deliver("customers", 1, customer("CUST-A"))
    deliver("products", 1, ("P1", *product))
    deliver("orders", 1, order("O1", "CUST-A"), order("O2", "CUST-A"))
    deliver("orders", None, order("O3", "CUST-A"))
    deliver("order_items", 1, ("I1", "O1", "P1", "1", "10", "0"))
    silver.run_silver(lake)
    assert silver_rows("orders", "order_id", "customer_id") == {("O1", "CUST-A"), ("O2", "CUST-A"), ("O3", "CUST-A")}
    # Beside the updates without parents a newer load moves the mark on.
    deliver("orders", 3, order("O1", "CUST-B"))
    deliver("order_items", 3, ("I1", "O1", "P2", "1", "10", "0"))
    deliver("orders", 5, order("O9", "CUST-A"))
    deliver("order_items", 5, ("I9", "O9", "P1", "1", "10", "0"))
    silver.run_silver(lake)
    assert ("O1", "CUST-A") in silver_rows("orders", "order_id", "customer_id")
    deliver("customers", 6, customer("CUST-B"))
    deliver("products", 6, ("P2", *product))
    deliver("orders", 4, order("O2", "CUST-B"))  # stamped before the mark, appended after it
    deliver("orders", 2, order("O3", "CUST-B"))  # its first row had no stamp
    silver.run_silver(lake)
    assert silver_rows("orders", "order_id", "customer_id") == {("O1", "CUST-B"), ("O2", "CUST-B"), ("O3", "CUST-B"), ("O9", "CUST-A")}
    assert silver_rows("order_items", "item_id", "product_id") == {("I1", "P2"), ("I9", "P1")}


def test_failed_step_is_logged(spark, lake, folder):
    with pytest.raises(quality.QualityError):
        runs.run_all(lake, str(folder), as_of="2023-03-01")
    log = {r.pipeline_name: r.status for r in lake.read("bronze", bronze.RUN_TABLE).collect()}
    assert log == {"bronze_loader": "success", "silver": "success", "quality_gate": "failed"}


def test_gate_blocks_and_stores(spark, lake, folder):
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    s = runs.staged(lake)
    with pytest.raises(quality.QualityError, match="no_future_orders_order_date: 2 rows"):
        quality.run_quality(lake, s, quality.gate_checks(as_of="2023-03-01"))
    assert lake.read("dq_failures", "no_future_orders_order_date").count() == 2
    assert {r.status for r in quality.run_quality(lake, s, quality.gate_checks()).collect()} == {"pass"}
    assert len(quality.table_checks()) == 23


def test_stream_equals_batch(spark, lake, folder, tmp_path):
    for name in ("customers",):
        parts = tmp_path / "arrivals"
        parts.mkdir()
        (parts / "a.csv").write_text(FILES[name])
        state = str(tmp_path / "state")
        ingest.stream_to_bronze(lake, ENTITIES[name], str(parts), state).awaitTermination()
        header = FILES[name].splitlines()[0]
        (parts / "b.csv").write_text(header + "\nCUST-1,late,row,,,,,,,B2C,2023-01-01\nCUST-7,new,row,,,,,,,B2C,2023-01-01\n")
        ingest.stream_to_bronze(lake, ENTITIES[name], str(parts), state).awaitTermination()
    assert lake.read("bronze", "raw_customers").count() == 6  # the known key is skipped
    ingest.stream_to_silver(lake, "customers", silver.clean_customers, str(tmp_path / "s2")).awaitTermination()
    streamed = current_rows(lake, "silver", "customers", "customer_id").drop("_updated_at")
    batch = silver.clean_customers(silver.last_written(lake.read("bronze", "raw_customers"), "customers")).drop("_updated_at")
    want = sorted(map(tuple, batch.collect()), key=str)
    assert sorted(map(tuple, streamed.collect()), key=str) == want and len(want) == 4
    compact(lake, "silver", "customers", "customer_id")
    assert sorted(map(tuple, lake.read("silver", "customers").drop("_updated_at").collect()), key=str) == want


def test_hot_event_is_stored_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from tallyhouse.streaming import events

    schema = "event_id string, event_timestamp timestamp"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(first: int, last: int) -> None:
        ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        rows = spark.range(first, last).select(ids.alias("event_id"), F.timestamp_seconds("id").alias("event_timestamp"))
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        events.store_distinct_events(stream, out, state).awaitTermination()

    arrive(0, 300)
    arrive(200, 400)  # a hundred come again, the hot one among them
    stored = spark.read.parquet(out).groupBy("event_id").count()
    assert stored.filter("count > 1").count() == 0
    assert stored.count() == 1 + sum(1 for i in range(400) if i % 3)
    assert spark.read.parquet(out).filter("event_id = 'hot'").first().event_timestamp.timestamp() == 0


def test_numbers_that_do_not_fit_are_rejected(spark, lake, folder):
    (folder / "products.csv").write_text(FILES["products"] + "P5,Ring,home,,Foo,5,123456789.50,3,S5\nP6,Nut,home,,Foo,1,2,99999999999,S6\n")
    (folder / "orders.csv").write_text(FILES["orders"] + "O7,CUST-1,2023-03-01,,Express,Done,99999999999.00,\n")
    (folder / "order_items.csv").write_text(FILES["order_items"] + "I6,O1,P1,99999999999,1,0\nI7,O1,P1,2000000000,99999999,0\n")
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    assert {r.product_id for r in lake.read("silver", "products").collect()} == {"P1", "P4"}
    assert "O7" not in {r.order_id for r in lake.read("silver", "orders").collect()}
    rejected = {(r.table, r.key, r.column, r.value) for r in lake.read("bronze", silver.REJECTED).collect()}
    assert rejected == {
        ("products", "P5", "selling_price", "123456789.50"), ("products", "P6", "stock_quantity", "99999999999"),
        ("orders", "O7", "total_amount", "99999999999.00"), ("order_items", "I6", "quantity", "99999999999"),
        ("order_items", "I7", "line_total", "2000000000 x 99999999")}


def test_rejected_values_are_stored_once(spark, lake, folder):
    """Runs without new files look at the dropped rows again, and store nothing."""
    (folder / "products.csv").write_text(FILES["products"] + "P9,Big,home,,Foo,1,99999999999,5,S9\n")
    bronze.run_bronze(lake, str(folder))
    for _ in range(3):
        silver.run_silver(lake)
    assert [(r.table, r.key, r.column) for r in lake.read("bronze", silver.REJECTED).collect()] == [("products", "P9", "selling_price")]


def test_second_run_reads_new_loads_only(spark, lake, folder, monkeypatch):
    """Loads in stamp order: bronze files that a run has taken in are not among those the next one reads."""
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    before = {e.bronze_table: set(lake.loads(e.bronze_table)) for e in (ENTITIES[t] for t in SILVER)}
    (folder / "orders.csv").write_text(FILES["orders"] + "O8,CUST-1,2023-03-07,,Express,Done,9,\n")
    bronze.run_bronze(lake, str(folder))
    opened = []
    read_loads = Lake.read_loads
    monkeypatch.setattr(Lake, "read_loads", lambda self, table, loads: opened.append((table, tuple(loads))) or read_loads(self, table, loads))
    marks = lake.read("bronze", silver.MARKS).filter("table = 'orders'").agg({"mark": "max"}).first()[0]
    new = [n for n in lake.loads("raw_orders") if n not in before["raw_orders"]]
    rows, _ = silver.new_rows(lake, "orders", sorted(before["raw_orders"]), new, marks)
    files = rows.inputFiles()
    assert files and all(f"load_id={new[0]}" in f for f in files)
    assert opened == [("raw_orders", tuple(new))]
    opened.clear()
    stats = {r.table: (r.candidates, r.written, r.dropped) for r in silver.run_silver(lake).collect()}
    assert all(not before[table] & set(loads) for table, loads in opened)
    # The order of the unknown customer waits and is looked at along with the new one.
    assert stats["orders"][1] == 1 and "O8" in {r.order_id for r in lake.read("silver", "orders").collect()}
    opened.clear()
    silver.run_silver(lake)
    assert opened == [] and silver.run_silver(lake).agg({"candidates": "sum"}).first()[0] == 0


def test_only_orphans_wait(spark, lake, folder):
    """An order without its customer waits; one with an unusable date or an amount that does not fit does not."""
    extra = "O7,CUST-1,2023-03-01,,Express,Done,99999999999.00,\nO8,CUST-1,never,,Express,Done,1,\nO9,CUST-99,2023-03-01,,Express,Done,1,\n"
    (folder / "orders.csv").write_text(FILES["orders"] + extra)
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    waiting = {r.order_id for r in lake.read(silver.WAITING, "orders").collect()}
    assert "O9" in waiting and not waiting & {"O7", "O8"}
    (folder / "customers.csv").write_text(FILES["customers"] + "CUST-99,new,row,,,,,,,B2C,2023-01-01\n")
    bronze.run_bronze(lake, str(folder))
    stats = {r.table: r.written for r in silver.run_silver(lake).collect()}
    assert stats["orders"] == 1 and "O9" in {r.order_id for r in lake.read("silver", "orders").collect()}
    assert "O9" not in {r.order_id for r in lake.read(silver.WAITING, "orders").collect()}


def test_a_newer_invalid_row_ends_the_wait(spark, lake, folder):
    (folder / "orders.csv").write_text(FILES["orders"] + "O9,CUST-99,2023-03-01,,Express,Done,1,\n")
    bronze.run_bronze(lake, str(folder))
    silver.run_silver(lake)
    (folder / "orders.csv").write_text(FILES["orders"].splitlines()[0] + "\nO9,CUST-99,never,,Express,Done,1,\n")
    (folder / "customers.csv").write_text(FILES["customers"] + "CUST-99,new,row,,,,,,,B2C,2023-01-01\n")
    bronze.run_bronze(lake, str(folder), mode="append_all")
    silver.run_silver(lake)
    assert "O9" not in {r.order_id for r in lake.read("silver", "orders").collect()}
    assert "O9" not in {r.order_id for r in lake.read(silver.WAITING, "orders").collect()}


def test_stream_rejects_equal_batch_rejects(spark, lake, folder, tmp_path):
    """Three batches with an unusable date and an amount that does not fit: nothing of them waits, each is rejected once."""
    bronze.run_bronze(lake, str(folder), ["customers"])
    silver_customers = silver.clean_customers(silver.last_written(lake.read("bronze", "raw_customers"), "customers"))
    rebuild(lake, "silver", "customers", silver_customers)
    header = FILES["orders"].splitlines()[0]
    for n in range(3):
        (folder / "orders.csv").write_text(f"{header}\nW{n},CUST-1,2023-03-01,,Express,Done,99999999999.00,\nD{n},CUST-1,never,,Express,Done,1,\nU{n},CUST-99,2023-03-01,,Express,Done,1,\n")
        bronze.run_bronze(lake, str(folder), ["orders"])
        ingest.stream_to_silver(lake, "orders", silver.clean_orders, str(tmp_path / "s"), parents=["customers"]).awaitTermination()
    streamed = sorted((r.key, r.column, r.value) for r in lake.read("bronze", silver.REJECTED).collect())
    rows = silver.last_written(lake.read("bronze", "raw_orders"), "orders")
    assert streamed == sorted((r.key, r.column, r.value) for r in silver.oversize_values(rows, "orders").collect()) and len(streamed) == 3
    last = spark.read.parquet(lake.path("waiting", "orders")).groupBy("batch").agg({"order_id": "collect_set"}).orderBy("batch").collect()[-1]
    assert set(last[1]) == {"U0", "U1", "U2"}


def test_silver_rows_are_stored_once(spark, lake, folder, monkeypatch):
    """Rows held against their parents are a table already: the upsert does not store them again."""
    bronze.run_bronze(lake, folder, strict=False)
    labels, store = [], scratch.store
    monkeypatch.setattr(scratch, "store", lambda df, label: (labels.append(label), store(df, label))[1])
    silver.run_silver(lake)
    assert "valid-order_items" in labels and not {"upsert-orders", "upsert-order_items"} & set(labels)
    assert lake.read("silver", "order_items").count() > 0
