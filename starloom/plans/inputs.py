"""Operator inputs derived from the given tables, each read whole.

The tables have no missing dimension rows, NULLs or dated snapshots of their
own. These come from their attributes and dates: a customer segment or product
type whose feed is late, negative balances as inactive customers, and customer
snapshots as the state of all orders before a day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import as_date
from starloom.functions.numbers import sum_of
from starloom.operators.calendar import date_dimension
from starloom.operators.lookup import Lookup, resolve
from starloom.operators.scd2 import ScdSpec
from starloom.operators.star import DimensionKey

# Schemas of the given tables; without them each read first opens the files.
TABLES = {
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, "
    "value DOUBLE, props STRING",
}

# Days the customer snapshots are taken; the last one follows the last order.
SNAPSHOT_DAYS = ("1996-01-01", "1996-07-01", "2001-08-02")
# A customer is in a snapshot if it ordered within this many days before it.
SNAPSHOT_REACH = 365
# Orders before 1996 find no date key.
CALENDAR = ("1996-01-01", "2001-12-31")
LATE_CUT = "2000-01-01"
LATE_SEGMENT = "MACHINERY"
LATE_TYPE = "ECONOMY"
COMPLETED = "F"

CUSTOMER_SPEC = ScdSpec(
    rename={
        "c_custkey": "customer_key",
        "c_name": "customer_name",
        "c_nationkey": "customer_nationkey",
        "c_mktsegment": "customer_market_segment",
        "best_priority": "customer_best_priority",
        "last_urgent": "customer_last_urgent",
        "credit_tier": "customer_credit_tier",
        "spent": "customer_spent",
    },
    key="customer_key",
    tracked=("customer_best_priority", "customer_last_urgent", "customer_credit_tier"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column) -> Column:
    """A price of the given tables as a decimal.

    They hold prices and rates of two decimals, as doubles; so a price, and the
    product of a price and a rate, is a decimal of four exactly.
    """
    return value.cast("decimal(18,4)")


def order_lines(spark: SparkSession, sf_dir: str, *take: str) -> DataFrame:
    """Order lines with columns of their order."""
    orders = table(spark, sf_dir, "orders")
    return resolve(
        table(spark, sf_dir, "lineitem"),
        [Lookup(orders, {"l_orderkey": "o_orderkey"}, take, "inner")],
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the shape of the fact loads' input."""
    lines = order_lines(spark, sf_dir, "o_custkey", "o_orderdate", "o_orderstatus")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("date_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
        F.col("o_orderstatus").alias("status"),
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("customer_sk"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("product_sk"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("p_size") <= 45).alias("is_active"),
    )


def dimension_keys(spark: SparkSession, sf_dir: str, late_arrived: bool) -> list[DimensionKey]:
    """Lookups of a fact load, before or after the late feeds have arrived."""
    customers, products = customer_dim(spark, sf_dir), product_dim(spark, sf_dir)
    if not late_arrived:
        customers = customers.where(F.col("segment") != LATE_SEGMENT)
        products = products.where(F.col("category") != LATE_TYPE)
    # Facts are a join of their own; how often a key occurs shows in its table.
    ordered = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"))
    bought = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"))
    return [
        DimensionKey(customers, "customer_id", "customer_sk", keys_from=ordered),
        DimensionKey(products, "product_id", "product_sk", keys_from=bought),
        DimensionKey(
            date_dimension(spark, *CALENDAR),
            "calendar_date",
            "date_sk",
            fact_key="date_id",
            active=None,
            required=False,
        ),
    ]


def customer_snapshot(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """Customers with a recent order, and the state of their orders before ``day``."""
    before = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _stamp(as_date(day)))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    state = (
        before.groupBy("o_custkey")
        .agg(
            F.min(F.substring("o_orderpriority", 1, 1).cast("int")).alias("best_priority"),
            F.max(F.when(urgent, F.col("o_orderdate"))).cast("date").alias("last_urgent"),
            sum_of(before, money(F.col("o_totalprice"))).cast("double").alias("spent"),
            F.max("o_orderdate").alias("last_order"),
        )
        .where(F.col("last_order") >= _stamp(as_date(day) - dt.timedelta(days=SNAPSHOT_REACH)))
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(state, customers.c_custkey == state.o_custkey).select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_mktsegment",
        "best_priority",
        "last_urgent",
        (F.floor(F.col("spent") / 500000) * F.lit(500000.0)).alias("credit_tier"),
        "spent",
        F.lit(as_date(day)).alias("snapshot_date"),
    )


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a feed that marks unknown values with a stand-in value."""
    lines = order_lines(spark, sf_dir, "o_orderpriority")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "o_orderpriority",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"),
        "l_linestatus",
    )


# rule_id, column_name, rule_type, rule_value, severity, description
DQ_RULES = (
    (1, "l_tax", "completeness", "NOT_NULL", "HIGH", "Tax should not be null"),
    (2, "o_orderpriority", "accuracy", "REGEX:^[1-3]-[A-Z]+$", "HIGH", "Valid priority"),
    (3, "l_quantity", "accuracy", "RANGE:3:47", "MEDIUM", "Valid quantity range"),
    (4, "l_orderkey,l_linenumber", "uniqueness", "UNIQUE", "HIGH", "Unique order line"),
    (5, "l_returnflag,l_linestatus", "consistency", "MAP:R=F;N=O,F", "MEDIUM", "Valid flag pair"),
    (6, "l_discount", "accuracy", "RANGE:0.01:0.09", "LOW", "Valid discount range"),
)


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested records: a struct of text, an array, and a map."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.struct(
            F.col("event_type").alias("name"),
            F.array("event_type", "props").alias("tags"),
            F.create_map("event_type", F.concat_ws(":", "event_type", "props")).alias("labels"),
            F.col("user_id"),
        ).alias("record"),
    )


def _stamp(day: dt.date) -> "F.Column":
    return F.lit(day).cast("timestamp_ntz")
