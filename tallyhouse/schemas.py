"""Entities, schemas and value domains of the retail model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    """One source file type: its file name, its key and the columns it must carry."""

    name: str
    key: str
    columns: tuple[str, ...]
    multiline: bool = False

    @property
    def file(self) -> str:
        return f"{self.name}.csv"

    @property
    def bronze_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# File columns and keys of the five source entities.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity("customers", "customer_id", (
            "customer_id", "first_name", "last_name", "email", "phone", "city", "state", "country",
            "zip_code", "customer_segment", "registration_date")),
        Entity("products", "product_id", (
            "product_id", "product_name", "category", "subcategory", "brand", "cost_price",
            "selling_price", "stock_quantity", "sku")),
        Entity("orders", "order_id", (
            "order_id", "customer_id", "order_date", "ship_date", "shipping_method", "order_status",
            "total_amount", "discount_code")),
        Entity("order_items", "item_id", (
            "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct")),
        Entity("events", "event_id", (
            "event_id", "customer_id", "event_type", "product_id", "event_timestamp", "session_id",
            "device_type")),
    )
}

# Accepted values and label limits.
ORDER_STATUSES = ("completed", "shipped", "processing", "cancelled", "returned")
CUSTOMER_SEGMENTS = ("B2B", "B2C")
EVENT_TYPES = ("page_view", "add_to_cart", "purchase")
DEVICE_TYPES = ("desktop", "mobile", "tablet")
MAX_LENGTHS = {"customer_segment": 10, "order_status": 30}
# Fixed value: prefix every valid customer key starts with.
CUSTOMER_KEY_PREFIX = "CUST-"

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)
# Reported sums and rounded means.
MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()
_STAMP = ("_updated_at", T.TimestampType())

SILVER: dict[str, T.StructType] = {
    "customers": _schema(
        ("customer_id", _S), ("first_name", _S), ("last_name", _S), ("full_name", _S), ("email", _S),
        ("phone", _S), ("city", _S), ("state", _S), ("country", _S), ("zip_code", _S),
        ("customer_segment", _S), ("registration_date", _D), _STAMP),
    "products": _schema(
        ("product_id", _S), ("product_name", _S), ("category", _S), ("subcategory", _S), ("brand", _S),
        ("cost_price", PRICE), ("selling_price", PRICE), ("margin_pct", PERCENT),
        ("stock_quantity", _I), ("sku", _S), _STAMP),
    "orders": _schema(
        ("order_id", _S), ("customer_id", _S), ("order_date", _D), ("ship_date", _D),
        ("days_to_ship", _I), ("shipping_method", _S), ("order_status", _S), ("total_amount", AMOUNT),
        ("discount_code", _S), _STAMP),
    "order_items": _schema(
        ("item_id", _S), ("order_id", _S), ("product_id", _S), ("quantity", _I), ("unit_price", PRICE),
        ("discount_pct", PERCENT), ("line_total", AMOUNT), _STAMP),
}

RUN_LOG = _schema(
    ("run_id", _S), ("pipeline_name", _S), ("run_date", _D), ("status", _S),
    ("rows_processed", T.LongType()), ("started_at", T.TimestampType()),
    ("completed_at", T.TimestampType()), ("error_message", _S))


def conform(df, table: str):
    """Project to the silver schema of ``table``: names, order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in SILVER[table].fields])
