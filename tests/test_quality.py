from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.sources import schemas

# The sample rule table.
RULES = [
    (1, "customer_name", "completeness", "NOT_NULL", "HIGH", "Name should not be null"),
    (2, "email", "accuracy", "REGEX:^[A-Za-z0-9+_.-]+@(.+)$", "HIGH", "Valid email format"),
    (3, "age", "accuracy", "RANGE:0:120", "MEDIUM", "Valid age range"),
    (4, "order_id", "uniqueness", "UNIQUE", "HIGH", "Unique order ID"),
    (5, "country,state", "consistency", "MAP:India=MP;USA=CA,TX", "MEDIUM", "Valid country-state mapping"),
]


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, schemas.DQ_RULES)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [
            ("a", "a@x.org", 10, "O1", "India", "MP"),
            (None, "bad", 121, "O1", "India", "CA"),
            ("c", None, None, "O2", "USA", "TX"),
            ("d", "d@y.org", -1, None, "USA", None),
            ("e", "@z", 120, None, None, "CA"),
            ("f", "f@x.org", 0, "O3", "France", "MP"),
            ("g", "g@x.org", 50, "O3", "USA", "CA"),
        ],
        "customer_name STRING, email STRING, age INT, order_id STRING, country STRING, state STRING",
    )


def counts(result):
    return {row["rule_id"]: row["failed_count"] for row in result.collect()}


def test_report_of_the_sample_rules(customers, rules):
    result = quality.run_rules(customers, rules)
    assert tuple(result.columns) == quality.RESULT_COLUMNS
    assert counts(result) == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2}
    row = result.where("rule_id = 5").head()
    assert (row["column_name"], row["severity"], row["comments"]) == (
        "country,state", "MEDIUM", "Valid country-state mapping",
    )


def test_table_is_scanned_once_for_all_row_rules(customers, rules, scratch, spark, capsys):
    customers.write.parquet(f"{scratch}/t")
    stored = spark.read.parquet(f"{scratch}/t")
    quality.run_rules(stored, rules).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 2
    assert "ReadSchema: struct<order_id:string>" in plan


def test_failing_rows_name_their_rules(customers, rules):
    failed = quality.failing_rows(customers, rules)
    found = {row["customer_name"]: row["failed_rules"] for row in failed.collect()}
    assert found == {None: [1, 2, 3, 5], "d": [3], "e": [2], "f": [5]}
    report = counts(quality.run_rules(customers, rules))
    exploded = failed.select(F.explode("failed_rules").alias("rule")).groupBy("rule").count()
    assert all(report[row["rule"]] == row["count"] for row in exploded.collect())


def test_duplicate_values_ignore_null(customers, rules):
    rule = quality.parse_rules(rules)[3]
    found = quality.duplicate_values(customers, rule).collect()
    assert sorted(row[:] for row in found) == [("O1", 2), ("O3", 2)]


def test_text_numbers_and_decimal_bounds(spark):
    df = spark.createDataFrame([("5", 0.5), ("x", 1.5), ("500", 0.24)], "age STRING, rate DOUBLE")
    rules = spark.createDataFrame(
        [
            (1, "age", "accuracy", "RANGE:0:120", None, None),
            (2, "rate", "accuracy", "RANGE:0.25:1", None, None),
        ],
        schemas.DQ_RULES,
    )
    result = quality.run_rules(df, rules)
    # Text that is no number is as wrong in a number column as 500.
    assert counts(result) == {1: 2, 2: 2}
    assert result.where("rule_id = 1").head()["comments"] == "range rule failed for age"


def test_regex_keeps_its_colons(spark):
    df = spark.createDataFrame([("10:30",), ("10-30",)], "t STRING")
    rules = spark.createDataFrame(
        [(1, "t", "accuracy", r"REGEX:^\d+:\d+$", None, None)], schemas.DQ_RULES
    )
    assert counts(quality.run_rules(df, rules)) == {1: 1}


def test_long_pair_list(spark):
    pairs = ";".join(f"c{i}=" + ",".join(f"s{i}_{j}" for j in range(10)) for i in range(30))
    df = spark.createDataFrame(
        [("c3", "s3_9"), ("c3", "s4_9"), ("c29", "s29_0"), ("zz", "s3_9")], "c STRING, s STRING"
    )
    rules = spark.createDataFrame(
        [(1, "c,s", "consistency", f"MAP:{pairs}", None, None)], schemas.DQ_RULES
    )
    assert counts(quality.run_rules(df, rules)) == {1: 2}


@pytest.mark.parametrize(
    ("column", "rule_type", "value"),
    [
        ("age", "freshness", "NOT_NULL"),
        ("age", "accuracy", "BETWEEN:1:2"),
        ("age", "accuracy", "RANGE:a:2"),
        ("age", "accuracy", "RANGE:1"),
        ("country", "consistency", "MAP:a=b"),
        ("country,state", "consistency", "MAP:ab"),
        ("nothing", "completeness", "NOT_NULL"),
    ],
)
def test_unreadable_rules_raise(spark, customers, column, rule_type, value):
    rules = spark.createDataFrame([(1, column, rule_type, value, None, None)], schemas.DQ_RULES)
    with pytest.raises(ValueError, match="rule 1"):
        quality.run_rules(customers, rules)


def test_one_hot_value_is_counted_before_the_shuffle(spark, capsys):
    df = spark.range(0, 50_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(1).alias("k"))
    rules = spark.createDataFrame([(1, "k", "uniqueness", "UNIQUE", None, None)], schemas.DQ_RULES)
    result = quality.run_rules(df, rules)
    assert counts(result) == {1: 1}
    result.explain()
    assert "partial_count" in capsys.readouterr().out


def test_rules_that_share_an_id_are_all_checked(spark):
    df = spark.createDataFrame([(1, None), (99, "x"), (5, "x")], "age INT, name STRING")
    same = [
        (3, "age", "accuracy", "RANGE:0:50", "LOW", "a"),
        (3, "name", "completeness", "NOT_NULL", "LOW", "b"),
    ]
    rules = spark.createDataFrame(same, schemas.DQ_RULES)
    got = {r["age"]: r["failed_rules"] for r in quality.failing_rows(df, rules).collect()}
    assert got == {1: [3], 99: [3]}
    with pytest.raises(ValueError, match="no id"):
        quality.parse_rules(spark.createDataFrame([(None, *same[0][1:])], schemas.DQ_RULES))


def test_any_number_of_rules_is_read(spark):
    many = [(i, "age", "completeness", "NOT_NULL", "LOW", "a") for i in range(10_001)]
    assert len(quality.parse_rules(spark.createDataFrame(many, schemas.DQ_RULES))) == 10_001
