"""Schemas of the CSV inputs as DDL text, so that no scan is spent on inference."""

from __future__ import annotations

CUSTOMER_DIM = (
    "customer_sk INT, customer_id STRING, customer_name STRING, gender STRING, age INT, "
    "city STRING, state STRING, country STRING, valid_from DATE, is_active BOOLEAN"
)

PRODUCT_DIM = (
    "product_sk INT, product_id STRING, product_name STRING, category STRING, "
    "subcategory STRING, brand STRING, price INT, valid_from DATE, is_active BOOLEAN"
)

ORDER_DETAILS = (
    "order_id STRING, customer_id STRING, product_id STRING, date_id DATE, "
    "quantity INT, unit_price DOUBLE, discount DOUBLE, status STRING"
)

DQ_RULES = (
    "rule_id INT, column_name STRING, rule_type STRING, rule_value STRING, "
    "severity STRING, description STRING"
)

CUSTOMER_SNAPSHOT = (
    "c_custkey INT, c_name STRING, c_address STRING, c_nationkey INT, c_phone STRING, "
    "c_acctbal DOUBLE, c_mktsegment STRING, c_comment STRING, snapshot_date DATE"
)
