from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators.keys import assign_surrogate_keys, max_key


@pytest.mark.parametrize("partitions", [1, 17])
def test_dense_in_key_order_for_any_partitioning(spark, partitions):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(partitions)
    numbered = assign_surrogate_keys(rows, "k", start=100, sk="sk").orderBy("k").collect()
    assert [row["sk"] for row in numbered] == list(range(101, 5101))


def test_many_partitions_are_used(spark, capsys):
    rows = spark.range(200_000).select((F.col("id") * 31).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_surrogate_keys(rows, "k", sk="sk")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(numbered.inputFiles()) == 8
    numbered.explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_one_hot_key_and_copies_divide_over_partitions(spark):
    rows = spark.range(0, 100_000, 1, 32).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_surrogate_keys(rows, "k", sk="sk")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(numbered.inputFiles()) >= 6
    assert numbered.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).head()[:] == (
        1, 100_000, 100_000,
    )


def test_ties_do_not_depend_on_partitioning(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    first, second = (
        {r["v"]: r["sk"] for r in assign_surrogate_keys(rows.repartition(n), "k", sk="sk").collect()}
        for n in (1, 13)
    )
    assert first == second


def test_continues_after_the_highest_key(spark):
    dim = spark.range(10, 20).select(F.col("id").alias("sk"))
    new = spark.range(3).select(F.col("id").alias("k"))
    numbered = assign_surrogate_keys(new, "k", start=max_key(dim, "sk"), sk="sk")
    assert sorted(row["sk"] for row in numbered.collect()) == [20, 21, 22]
    none = dim.where("sk < 0")
    assert assign_surrogate_keys(new, "k", max_key(none, "sk"), "sk").agg(F.min("sk")).head()[0] == 1


def test_no_rows(spark):
    assert assign_surrogate_keys(spark.range(0), "id", sk="sk").count() == 0


def test_rows_with_maps(spark):
    rows = spark.range(10).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"))
    numbered = assign_surrogate_keys(rows, "id", sk="sk").orderBy("id").collect()
    assert [(row["sk"], row["m"]["k"]) for row in numbered] == [(i + 1, i) for i in range(10)]
