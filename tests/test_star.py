from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import samples
from starloom.functions import mean_of, sum_of
from starloom.operators import lookup, star
from starloom.operators.calendar import date_dimension
from starloom.operators.star import DimensionKey


def keys(spark, customers=None, products=None, **options):
    return [
        DimensionKey(customers or samples.customers(spark), "customer_id", "customer_sk", **options),
        DimensionKey(products or samples.products(spark), "product_id", "product_sk"),
        DimensionKey(
            date_dimension(spark), "calendar_date", "date_sk", "date_id",
            active=None, required=False,
        ),
    ]


@pytest.fixture(scope="module")
def fact(spark):
    return star.load_fact(samples.orders(spark), keys(spark), "keep")


def test_fact_of_the_sample(fact):
    assert fact.columns == [
        "order_id", "quantity", "unit_price", "discount", "status",
        "customer_sk", "product_sk", "date_sk",
    ]
    rows = fact.orderBy("order_id").collect()
    assert [row["date_sk"] for row in rows] == list(range(366, 381))
    assert all(value is not None for row in rows for value in row)


def test_modes(spark):
    customers = samples.customers(spark).withColumn(
        "is_active",
        F.when(F.col("customer_id") == "C001", False).when(F.col("customer_id") != "C002", True),
    )
    raw = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    found = {
        mode: star.load_fact(raw, keys(spark, customers), mode) for mode in star.MODES
    }
    assert {mode: df.count() for mode, df in found.items()} == {
        "keep": 18, "active": 8, "suspend": 18,
    }
    missing = F.col("customer_sk").isNull()
    assert found["keep"].where(missing).count() == 3
    # C001 is inactive; C002 has no flag and counts as active only when suspending.
    assert found["suspend"].where(missing).count() == 7
    assert {"customer_id", "product_id", "date_id"} <= set(found["suspend"].columns)
    with pytest.raises(ValueError):
        star.load_fact(raw, keys(spark), "other")


def test_date_stays_optional(spark):
    raw = samples.orders(spark).withColumn("date_id", F.lit("2030-01-01").cast("date"))
    loaded = star.load_fact(raw, keys(spark), "active")
    assert loaded.count() == 15
    assert loaded.where("date_sk is null").count() == 15


def test_versions_of_a_dimension(spark):
    versions = samples.customers(spark).unionByName(
        samples.customers(spark).withColumns(
            {"customer_sk": F.col("customer_sk") + 100, "valid_from": F.lit("2027-01-01").cast("date")}
        )
    )
    with pytest.raises(ValueError, match="multiply"):
        star.load_fact(samples.orders(spark), keys(spark, versions), "keep")
    loaded = star.load_fact(samples.orders(spark), keys(spark, versions, latest_by="valid_from"))
    assert loaded.count() == 15
    assert loaded.agg(F.min("customer_sk")).head()[0] == 101


def test_categories(spark, fact):
    products = samples.products(spark)
    revenue = star.category_revenue(fact, products).collect()
    assert {tuple(row) for row in revenue} == {("Electronics", 504178.0), ("Furniture", 206795.0)}
    sales = star.category_sales(fact, products).collect()
    assert {tuple(row) for row in sales} == {
        ("Electronics", 18, 504178.0, 10), ("Furniture", 4, 206795.0, 3),
    }


def test_categories_of_many_products(spark, fact, monkeypatch):
    products = samples.products(spark)
    expected = sorted(star.category_revenue(fact, products).collect())
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert sorted(star.category_revenue(fact, products).collect()) == expected


def test_customers(spark, fact):
    profile = star.customer_revenue(fact, samples.customers(spark)).orderBy("customer_sk")
    rows = [(r[0], r[1], r[2], round(r[3], 2), r[4], r[5]) for r in profile.collect()]
    assert rows == [
        (1, "Arjun Mehta", 189520.0, 47500.0, 80000.0, 15000.0),
        (2, "Neha Sharma", 149878.0, 75000.0, 75000.0, 75000.0),
        (3, "Rahul Verma", 319725.0, 106666.67, 120000.0, 80000.0),
        (4, "Priya Singh", 44900.0, 15000.0, 15000.0, 15000.0),
        (5, "Amit Patel", 6950.0, 7000.0, 7000.0, 7000.0),
    ]
    ranked = star.top_customers(fact, samples.customers(spark), 3).collect()
    assert [(r[0], r[2], r[3], round(r[4], 2), r[5]) for r in ranked] == [
        (3, 3, 319725.0, 106575.0, 3),
        (1, 4, 189520.0, 47380.0, 4),
        (2, 2, 149878.0, 74939.0, 4),
    ]


def test_amount_is_an_argument(spark, fact):
    gross = star.category_revenue(
        fact, samples.products(spark), amount=F.col("unit_price") * F.col("quantity")
    )
    assert {row["category"] for row in gross.collect()} == {"Electronics", "Furniture"}
    assert gross.where("category = 'Furniture'").head()["total_amount"] == 214000.0


def total(df, value="v"):
    return df.agg(sum_of(df, F.col(value))).head()[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_keep_every_value(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        tiny = spark.range(100_000).select(F.lit(0.00001).alias("v"))
        assert total(tiny) == pytest.approx(1.0, rel=1e-9)
        third = spark.range(3000).select(F.lit(0.33333).alias("v"))
        assert total(third) == pytest.approx(999.99, rel=1e-9)
        for values, expected in (
            ([1.0, float("nan"), 2.0], "nan"),
            ([1.0, float("inf"), 2.0], "inf"),
            ([1e34, 1e34], "2e+34"),
            ([None, None], "None"),
        ):
            df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
            assert str(total(df)) == expected
        assert math.isnan(df.sparkSession.createDataFrame([(1.0,), (float("nan"),)], "v DOUBLE").agg(
            mean_of(df, F.col("v"))
        ).head()[0])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_sums_of_decimals_are_exact_in_any_order(spark):
    values = [(Decimal(i) / 10000,) for i in range(10_000)] + [(Decimal("99999999999999.9999"),)] * 5
    df = spark.createDataFrame(values, "v DECIMAL(18,4)")
    sums = {total(df.repartition(n)) for n in (1, 3, 17)}
    assert sums == {sum(v for v, in values)}
    assert df.agg(mean_of(df, F.col("v"))).head()[0] == float(sum(v for v, in values)) / len(values)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_repeated_dimension_keys_are_refused_in_reports(spark, fact, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    twice = [frame.unionByName(frame) for frame in (samples.products(spark), samples.customers(spark))]
    for report, dim in (
        (star.category_revenue, twice[0]), (star.category_sales, twice[0]),
        (star.customer_revenue, twice[1]), (star.top_customers, twice[1]),
    ):
        with pytest.raises(ValueError, match="multiply"):
            report(fact, dim)


def test_category_sales_run_the_fact_once(spark, fact, monkeypatch, tmp_path):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        runs.add(1)
        yield from batches

    counted = fact.coalesce(1).mapInArrow(seen, fact.schema)
    products = samples.products(spark)
    report = star.category_sales(counted, products, keys_from=products.select("product_sk"))
    report.write.parquet(str(tmp_path / "report"))
    assert runs.value == 1


def test_category_sales_hold_no_row_for_each_product_and_order(spark, fact, capsys):
    """Sales are labelled first: only (category, order) pairs are held in memory."""
    products = samples.products(spark)
    report = star.category_sales(fact, products)
    report.explain()
    plan = capsys.readouterr().out
    assert not [line for line in plan.splitlines() if "Aggregate(keys=[product_sk" in line]
    completed = fact.where("status = 'COMPLETED'").join(products, "product_sk")
    expected = completed.groupBy("category").agg(F.sum("quantity"), F.countDistinct("order_id")).collect()
    assert sorted((r[0], r[1], r[3]) for r in report.collect()) == sorted(map(tuple, expected))
