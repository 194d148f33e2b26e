"""The registered loads with dimensions too large to broadcast and skewed facts."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from starloom.operators import lookup
from starloom.plans import ORACLE, QUERIES, inputs
from test_oracle import ordered

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.fixture()
def shuffled(spark, monkeypatch):
    """No table fits a broadcast, and a key is hot from 50 rows on."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """The tables with a third of the lines on one order and one part."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ("customer", "part", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    hot = F.col("l_linenumber") <= 2
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    lines.withColumns(
        {name: F.when(hot, 7).otherwise(F.col(name)) for name in ("l_orderkey", "l_partkey")}
    ).repartition(24).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "fact_keep", "fact_active", "category_revenue", "category_sales", "customer_revenue",
        "late_next_cycle", "late_still_suspended", "dq_report",
    ],
)
def test_skewed_tables_by_shuffle(spark, shuffled, skewed_dir, name):
    duck = duckdb.connect()
    for table in ("customer", "part", "orders", "lineitem"):
        duck.execute(
            f"create view {table} as select * from read_parquet('{skewed_dir}/{table}.parquet/*.parquet')"
        )
    ours = QUERIES[name](spark, skewed_dir)
    theirs = duck.execute(ORACLE[name])
    names = [column[0] for column in theirs.description]
    got = ordered(ours.columns, [tuple(row) for row in ours.collect()])
    assert got == ordered(names, theirs.fetchall())


def test_hot_order_is_salted(spark, shuffled, skewed_dir, capsys):
    inputs.raw_orders(spark, skewed_dir).explain()
    plan = capsys.readouterr().out
    assert "SPARK_PARTITION_ID" in plan
    assert plan.count("BroadcastExchange") == 1
