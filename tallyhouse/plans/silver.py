"""Bronze text rows into typed, cleaned, de-duplicated silver tables."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import parse, text
from tallyhouse.operators import scratch
from tallyhouse.operators.keys import known_keys, latest_per_key, with_parent, without_known
from tallyhouse.operators.publish import append, counted_rows, rebuild, rows_of, upsert
from tallyhouse.plans import generated
from tallyhouse.schemas import AMOUNT, CUSTOMER_KEY_PREFIX, ENTITIES, PRICE, conform
from tallyhouse.sources.tables import LOAD, Lake, current_version

log = logging.getLogger(__name__)


def last_written(bronze: DataFrame, entity: str) -> DataFrame:
    """The last ingested row per key; within one load the last one in the file. The later load decides between equal places."""
    ties = [F.desc(LOAD)] if LOAD in bronze.columns else []
    return latest_per_key(bronze, ENTITIES[entity].key, F.desc("_ingested_at"), F.desc("_row_id"), *ties)


def clean_customers(rows: DataFrame) -> DataFrame:
    c = F.col
    valid = rows.filter(c("customer_id").startswith(CUSTOMER_KEY_PREFIX)).dropna(
        subset=["customer_id", "first_name", "last_name"])
    named = valid.withColumns({
        "first_name": text.title_case(c("first_name")),
        "last_name": text.title_case(c("last_name")),
        "email": text.clean_email(c("email")),
        "state": text.upper_code(c("state")),
        "country": text.upper_code(c("country")),
        "customer_segment": text.upper_code(c("customer_segment")),
        "registration_date": parse.clean_date(c("registration_date")),
        "_updated_at": F.current_timestamp(),
    })
    return conform(named.withColumn("full_name", generated.full_name(c("first_name"), c("last_name"))), "customers")


def clean_products(rows: DataFrame) -> DataFrame:
    c = F.col
    priced = parse.with_parsed(rows, {
        "cost_price": parse.clean_money(c("cost_price"), PRICE),
        "selling_price": parse.clean_money(c("selling_price"), PRICE),
        "stock_quantity": parse.clean_int(c("stock_quantity")),
    }).dropna(subset=["stock_quantity"]).filter(
        (c("selling_price") > 0) & (c("cost_price") >= 0) & (c("cost_price") <= c("selling_price")))
    return conform(priced.withColumns({
        "product_name": text.strip(c("product_name")),
        "category": text.title_case(c("category")),
        "brand": text.strip(c("brand")),
        "margin_pct": generated.margin_pct(c("selling_price"), c("cost_price")),
        "_updated_at": F.current_timestamp(),
    }), "products")


def clean_orders(rows: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """``customers`` is the silver table: orders of unknown customers are dropped. Without it no parent is asked for."""
    c = F.col
    typed = parse.with_parsed(rows, {
        "order_date": parse.clean_date(c("order_date")),
        "ship_date": parse.clean_date(c("ship_date")),
        "total_amount": parse.clean_money(c("total_amount")),
        "order_status": parse.standardize_status(c("order_status")),
    })
    valid = typed.dropna(subset=["order_id", "customer_id", "order_date"]).filter(c("total_amount") >= 0)
    known = valid if customers is None else with_parent(valid, customers, "customer_id")
    return conform(known.withColumns({
        "days_to_ship": generated.days_to_ship(c("order_date"), c("ship_date")),
        "_updated_at": F.current_timestamp(),
    }), "orders")


def clean_order_items(rows: DataFrame, orders: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """``orders`` and ``products`` are silver tables: lines without either parent are dropped. A parent left out is not asked for."""
    c = F.col
    typed = parse.with_parsed(rows, {
        "quantity": parse.clean_quantity(c("quantity")),
        "unit_price": parse.clean_money(c("unit_price"), PRICE),
        "discount_pct": parse.clean_percent(c("discount_pct")),
    }).dropna(subset=["quantity", "unit_price"])
    known = typed if products is None else with_parent(typed, products, "product_id")
    known = known if orders is None else with_parent(known, orders, "order_id")
    total = generated.line_total(c("quantity"), c("unit_price"), c("discount_pct"))
    priced = parse.with_parsed(known.withColumn("line_total", F.lit(None)), {"line_total": total})
    return conform(priced.withColumn("_updated_at", F.current_timestamp()).dropna(subset=["line_total"]), "order_items")


# Measured columns whose numbers must fit a type.
MEASURES = {
    "products": {"cost_price": PRICE, "selling_price": PRICE, "stock_quantity": "int"},
    "orders": {"total_amount": AMOUNT},
    "order_items": {"quantity": "int", "unit_price": PRICE},
}
REJECTED = "rejected_values"


def oversize_values(rows: DataFrame, entity: str) -> DataFrame:
    """(table, key, column, value) of numbers that do not fit their column; their rows stay out of silver."""
    c, key = F.col, ENTITIES[entity].key
    measures = MEASURES.get(entity, {})
    found = [F.when(parse.does_not_fit(c(m), as_type), F.struct(F.lit(m).alias("column"), c(m).alias("value"))) for m, as_type in measures.items()]
    suspect = [parse.may_not_fit(c(m), as_type) for m, as_type in measures.items()]
    if entity == "order_items":
        quantity, price = parse.clean_quantity(c("quantity")), parse.clean_money(c("unit_price"), PRICE)
        total = generated.line_total(quantity, price, parse.clean_percent(c("discount_pct")))
        both = F.concat_ws(" x ", "quantity", "unit_price")
        found.append(F.when(total.isNull() & quantity.isNotNull() & price.isNotNull(), F.struct(F.lit("line_total").alias("column"), both.alias("value"))))
        suspect.append(parse.product_may_not_fit(c("quantity"), c("unit_price"), AMOUNT))
    each = F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<column:string,value:string>>")
    # Few rows have any: those whose texts are plainly short are not parsed.
    rows = rows.filter(reduce(lambda a, b: a | b, suspect)) if suspect else rows
    return rows.select(F.lit(entity).alias("table"), c(key).alias("key"), F.inline(each))


def new_rejects(lake: Lake, found: DataFrame) -> DataFrame:
    """The rejected values that no earlier run stored: a row that waits for a parent is looked at by every run."""
    if not lake.has("bronze", REJECTED):
        return found
    return found.join(lake.read("bronze", REJECTED).select(*found.columns), found.columns, "left_anti")


# Parents come before the tables that refer to them.
STEPS = (
    ("customers", clean_customers, ()),
    ("products", clean_products, ()),
    ("orders", clean_orders, ("customers",)),
    ("order_items", clean_order_items, ("orders", "products")),
)


# Loads that silver has taken in (a row each), with the latest stamp in them and the parents' versions of that run.
MARKS = "silver_loads"
_MARKS = "table string, load string, mark timestamp, parents string, at timestamp"
# Layer of the bronze rows that are valid but lack a parent.
WAITING = "waiting_rows"


def _place() -> Column:
    """Place of a bronze row in the order of ``last_written``; a missing stamp comes first."""
    return F.struct(F.col("_ingested_at").alias("stamp"), F.col("_row_id").alias("row"))


def with_parents_found(lake: Lake, valid: DataFrame, parents: Sequence[str]) -> tuple[DataFrame, Column]:
    """``valid`` with a mark for each parent that silver has, and the condition that it has all of them."""
    found = valid
    for p in parents:
        key = ENTITIES[p].key
        found = found.join(known_keys(lake.read("silver", p), key).withColumn(f"_has_{p}", F.lit(True)), key, "left")
    return found, reduce(lambda a, b: a & b, [F.col(f"_has_{p}").isNotNull() for p in parents])


def orphan_rows(rows: DataFrame, valid: DataFrame, cleaned: DataFrame, entity: str, parents: Sequence[str]) -> DataFrame:
    """The rows that only a parent keeps out of silver: ``valid`` holds what the rules let through, ``cleaned`` what got in.

    Rows that break a rule or hold a number that does not fit can never get in, nor can those whose reference is missing.
    """
    return _of_keys(rows, without_known(valid, cleaned, ENTITIES[entity].key), entity, parents)


def _of_keys(rows: DataFrame, lacking: DataFrame, entity: str, parents: Sequence[str]) -> DataFrame:
    """The rows whose key is among those of ``lacking`` that refer to something."""
    key = ENTITIES[entity].key
    lacking = lacking.dropna(subset=[ENTITIES[p].key for p in parents])
    return rows.join(lacking.select(key), key, "left_semi").select(*rows.columns)


def new_rows(lake: Lake, table: str, taken: Sequence[str], new: Sequence[str], mark: dt.datetime | None) -> tuple[DataFrame, dt.datetime | None]:
    """The last row per key of the new loads, less those that an older load outdoes, and the latest stamp so far.

    Only new loads are read where all their stamps lie after the mark. Rows without a stamp, or stamped before the mark
    though appended after it, are held against key and place of the older loads' rows of the same keys.
    """
    entity = ENTITIES[table]
    rows = lake.read_loads(entity.bronze_table, new)
    first, last, unstamped = rows.agg(F.min("_ingested_at"), F.max("_ingested_at"), F.count_if(F.col("_ingested_at").isNull())).first()
    newest = last_written(rows, table)
    if taken and (unstamped or (first is not None and (mark is None or first <= mark))):
        older = lake.read_loads(entity.bronze_table, taken).select(entity.key, "_ingested_at", "_row_id")
        places = with_parent(older, newest, entity.key).groupBy(entity.key).agg(F.max(_place()).alias("_older"))
        placed = newest.join(places, entity.key, "left").filter(F.col("_older").isNull() | (_place() >= F.col("_older")))
        newest = placed.select(*newest.columns)
    return newest, max((m for m in (mark, last) if m is not None), default=None)


def pending_rows(lake: Lake, table: str, parents: Sequence[str], full: bool = False) -> tuple[DataFrame | None, list[tuple]]:
    """The bronze rows that silver has to look at, one per key, and the marks to store once it has; no rows if nothing is new.

    These are the rows of loads that silver has not taken in, and the waiting rows, which a newer row of their key replaces.
    Waiting rows alone are tried again only if a parent table has a new version. ``full``: the rows of all loads.
    """
    entity = ENTITIES[table]
    loads = lake.loads(entity.bronze_table)
    if not loads:
        raise FileNotFoundError(f"bronze.{entity.bronze_table} has no finished load")
    marks = lake.read("bronze", MARKS).filter(F.col("table") == table) if lake.has("bronze", MARKS) and lake.has("silver", table) else None
    known = [] if full or marks is None else marks.collect()  # one row a load
    taken = {m["load"] for m in known} - {None}
    stamps = [m["mark"] for m in known if m["mark"] is not None]
    mark = max(stamps, default=None)
    new = [n for n in loads if n not in taken]
    versions = "|".join(str(current_version(lake.spark, lake.path("silver", p))) for p in parents)
    tried = max(known, key=lambda m: m["at"])["parents"] if known else None
    waiting = lake.read(WAITING, table) if parents and not full and lake.has(WAITING, table) else None
    now = dt.datetime.now()
    if not new:
        if waiting is None or tried == versions:
            return None, []
        return waiting, [(table, None, mark, versions, now)]
    rows, mark = new_rows(lake, table, [n for n in loads if n in taken], new, mark)
    if waiting is not None:
        rows = last_written(rows.unionByName(waiting), table)
    return rows, [(table, n, mark, versions, now) for n in new]


def run_silver(lake: Lake, full: bool = False) -> DataFrame:
    """Clean and upsert what is new in the four tables; the first failure stops the run.

    ``full`` cleans all bronze rows again, as after a change of the rules. Returns one row per table with the numbers of
    candidate, written and dropped rows; dropped ones that only lack a parent wait for it. Numbers that do not fit their
    column are appended to the table of rejected values, with the id of the run. A run that failed half-way is repeated with the same loads.
    """
    run = uuid.uuid4().hex
    stats = []
    for table, clean, parents in STEPS:
        with scratch.scope(lake.spark):
            pending, marks = pending_rows(lake, table, parents, full)
            counts = (0, 0)
            if pending is not None:
                new = [load for _, load, *_ in marks if load is not None]
                size = (lake.read_loads(ENTITIES[table].bronze_table, new) if new else pending).count()
                with scratch.partitions_for(lake.spark, size):
                    counts = _take_in(lake, table, clean, parents, pending, run)
        if marks:
            append(lake, MARKS, lake.spark.createDataFrame(marks, _MARKS).coalesce(1))
        stats.append((table, *counts, counts[0] - counts[1]))
    return lake.spark.createDataFrame(stats, "table string, candidates long, written long, dropped long")


def _take_in(lake: Lake, table: str, clean, parents: Sequence[str], pending: DataFrame, run: str) -> tuple[int, int]:
    """Put pending rows into silver, the waiting and the rejected ones aside; returns the numbers of candidates and written rows."""
    entity = ENTITIES[table]
    # Read for the silver rows, the waiting rows and the rejected values.
    pending, seen = counted_rows(pending, f"{table}_in_{run}")
    rows, _ = scratch.store(pending, f"pending-{table}")
    valid = clean(rows)
    if parents:
        # One look at the parents tells the silver rows and the waiting ones.
        found, complete = with_parents_found(lake, valid, parents)
        found, _ = scratch.store(found, f"valid-{table}")
        valid = found.filter(complete).select(*valid.columns)
    cleaned, kept = counted_rows(valid, f"{table}_out_{run}")
    upsert(lake, "silver", table, cleaned, entity.key, stored=bool(parents))
    if parents:
        rebuild(lake, WAITING, table, _of_keys(rows, found.filter(~complete), table, parents))
    before, after = rows_of(seen), rows_of(kept)
    if before != after:
        log.warning("[%s] %d invalid or orphan rows stay out", table, before - after)
    if table in MEASURES:
        oversize, rejected = counted_rows(new_rejects(lake, oversize_values(rows, table)).withColumn("run_id", F.lit(run)), f"{table}_rejected_{run}")
        append(lake, REJECTED, oversize)
        if rows_of(rejected):
            log.warning("[%s] rejected %d numbers that do not fit", table, rows_of(rejected))
    return before, after
