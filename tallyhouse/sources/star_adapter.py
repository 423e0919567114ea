"""Star-schema order tables read as silver tables.

Maps ``customer``, ``nation``, ``region``, ``part``, ``orders`` and ``lineitem`` Parquet files to the
four silver relations, so that the gold models and reports run over them unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans import generated


# Declared, so that reading a table costs no schema inference job.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def key(prefix: str, column: str) -> str:
    """SQL text of a retail key such as ORD-000000042."""
    return f"concat('{prefix}-', lpad(cast({column} as string), 9, '0'))"


NO_STAMP = "cast(null as timestamp) as _updated_at"


@dataclass
class StarTables:
    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.raw("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            f"{key('CUST', 'c_custkey')} as customer_id",
            "split_part(c_name, '#', 1) as first_name",
            "split_part(c_name, '#', 2) as last_name",
            "c_name as full_name",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') as email",
            "cast(null as string) as phone",
            "cast(null as string) as city",
            "n_name as state",
            "r_name as country",
            "cast(null as string) as zip_code",
            "case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'B2B' else 'B2C' end as customer_segment",
            "date_add(date'1995-01-01', cast(c_custkey % 730 as int)) as registration_date",
            NO_STAMP,
        )

    @cached_property
    def products(self) -> DataFrame:
        base = self.raw("part").selectExpr(
            f"{key('PROD', 'p_partkey')} as product_id",
            "p_name as product_name",
            "p_type as category",
            "split_part(p_name, ' ', 2) as subcategory",
            "p_brand as brand",
            "cast(round(cast(p_retailprice as decimal(10,2)) * cast(0.2D + (p_size % 8) * 0.1D as decimal(3,1)), 2) as decimal(10,2)) as cost_price",
            "cast(p_retailprice as decimal(10,2)) as selling_price",
            "cast(p_partkey % 60 as int) as stock_quantity",
            "concat('SKU-', cast(p_partkey as string)) as sku",
            NO_STAMP,
        )
        return base.withColumn("margin_pct", generated.margin_pct(F.col("selling_price"), F.col("cost_price")))

    @cached_property
    def orders(self) -> DataFrame:
        shipped = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_shipdate").cast("date").alias("ship_date"))
        headers = self.raw("orders").join(shipped, "o_orderkey", "left").selectExpr(
            f"{key('ORD', 'o_orderkey')} as order_id",
            f"{key('CUST', 'o_custkey')} as customer_id",
            "cast(o_orderdate as date) as order_date",
            "ship_date",
            "o_orderpriority as shipping_method",
            """case when o_orderstatus = 'F' then 'completed'
                    when o_orderstatus = 'P' and o_orderkey % 2 = 0 then 'returned'
                    when o_orderstatus = 'P' then 'cancelled'
                    when o_orderkey % 2 = 0 then 'shipped' else 'processing' end as order_status""",
            "cast(o_totalprice as decimal(12,2)) as total_amount",
            "case o_orderkey % 5 when 0 then ' SAVE10 ' when 1 then '' when 2 then 'VIP25' end as discount_code",
            NO_STAMP,
        )
        return headers.withColumn("days_to_ship", generated.days_to_ship(F.col("order_date"), F.col("ship_date")))

    @cached_property
    def order_items(self) -> DataFrame:
        lines = self.raw("lineitem").withColumn("order_id", F.expr(key("ORD", "l_orderkey")))
        price, quantity = "cast(l_extendedprice as decimal(12,2))", "cast(l_quantity as int)"
        return lines.selectExpr(
            "concat('ITEM-', concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
            "cast(l_partkey as string), cast(l_suppkey as string))) as item_id",
            "order_id",
            f"{key('PROD', 'l_partkey')} as product_id",
            f"{quantity} as quantity",
            f"cast(round({price} / nullif({quantity}, 0), 2) as decimal(10,2)) as unit_price",
            "cast(l_discount * 100 as decimal(5,2)) as discount_pct",
            f"cast(round({price} * (1 - cast(l_discount as decimal(4,2))), 2) as decimal(12,2)) as line_total",
            NO_STAMP,
        )
