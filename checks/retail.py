"""Gold tables over one folder of test tables, built on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans import dimensions, facts, marketing, metrics, staging
from tallyhouse.sources.star_adapter import StarTables

START, END, AS_OF = "1995-01-01", "2001-12-31", "2001-12-31"


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.silver = StarTables(spark, folder)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.silver.customers)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(self.silver.products)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.silver.orders)

    @cached_property
    def items(self) -> DataFrame:
        return staging.stg_order_items(self.silver.order_items)

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.dim_date(self.spark, START, END, AS_OF)

    @cached_property
    def customer_orders(self) -> DataFrame:
        return metrics.int_customer_orders(self.orders, self.items)

    @cached_property
    def product_metrics(self) -> DataFrame:
        return metrics.int_product_metrics(self.items, self.orders, self.products)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.customers, self.customer_orders)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.products, self.product_metrics)

    @cached_property
    def lines(self) -> DataFrame:
        """The fact without the customer scores, which no sales report reads."""
        return facts.fact_orders(self.items, self.orders, self.products, self.customers, self.dates)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_orders(self.items, self.orders, self.products, self.dim_customers, self.dates)

    @cached_property
    def ltv(self) -> DataFrame:
        return marketing.customer_ltv(self.dim_customers, AS_OF)
