"""The shop model: customers, products, orders and order lines.

Analyses are written against this model only. ``from_csv`` binds the CSV files,
``from_star`` binds Parquet tables in the usual order/line/part star schema.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import read_csv, read_parquet
from .schemas import schema

MONEY = "decimal(15,2)"
TOTAL = "decimal(20,2)"


def cents_to_money(cents: Column) -> Column:
    """Whole cents as an exact decimal amount."""
    return (cents.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


@dataclass(frozen=True)
class Shop:
    """Lines carry their amount twice: as a decimal, and as whole ``cents`` for the sums over raw
    lines, which are much cheaper on integers and just as exact."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    done: str = "completed"

    def completed_orders(self) -> DataFrame:
        """Orders that count as sales. The filter reaches the scan."""
        return self.orders.where(F.col("status") == self.done)


def from_csv(spark: SparkSession, folder: str) -> Shop:
    def load(name: str) -> DataFrame:
        return read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema(name))

    value = F.col("quantity").cast("bigint") * F.col("unit_price")
    items = load("order_items").withColumns({"amount": value.cast(MONEY), "cents": value * 100})
    return Shop(load("customers"), load("products"), load("orders"), items)


def from_star(spark: SparkSession, folder: str) -> Shop:
    def load(name: str) -> DataFrame:
        return read_parquet(spark, folder, name)

    customers = load("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("area_id"),
        F.col("c_mktsegment").alias("acquisition_channel"),
    )
    price = F.col("p_retailprice").cast(MONEY)
    products = load("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        price.alias("price"),
        (price * F.lit("0.6").cast("decimal(3,1)")).cast(MONEY).alias("cost"),
    )
    orders = load("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
    )
    items = load("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        (F.col("l_extendedprice").cast(MONEY) * 100).cast("bigint").alias("cents"),
    )
    return Shop(customers, products, orders, items, done="F")


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the areas customers live in: ``area_id, prefecture, region_id``."""
    return read_parquet(spark, folder, "nation").select(
        F.col("n_nationkey").alias("area_id"),
        F.col("n_name").alias("prefecture"),
        F.col("n_regionkey").alias("region_id"),
    )
