from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators import lookup
from starloom.operators.lookup import Lookup, Skew, find_skew, fits_broadcast, resolve


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a third without a key, and unknown keys."""
    third = F.col("id") % 3
    return spark.range(0, 30_000, 1, 500).select(
        "id", F.when(third == 0, 7).when(third == 1, F.col("id") % 2000).alias("k")
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(1500).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("n"), "id")).alias("name"),
    )


@pytest.fixture()
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1000, 10**9])
def test_both_strategies_give_the_plain_join(facts, dim, how, hot_rows, no_auto_broadcast):
    lookup = Lookup(dim, {"k": "key"}, ["name"], how)
    expected = facts.join(dim, facts.k == dim.key, how).drop("key")
    salted = resolve(facts, [lookup], broadcast_bytes=0, hot_rows=hot_rows)
    assert rows(resolve(facts, [lookup])) == rows(expected)
    assert rows(salted) == rows(expected)
    if how == "left":
        assert salted.count() == facts.count()


def test_skew_found_in_one_sketch(facts, spark):
    found = find_skew(facts, [["k"], ["id"]], hot_rows=5000)
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).head()[0]
    assert found == [Skew((seven,), nulls=True), Skew()]


def test_even_keys_are_not_salted(facts, dim, capsys, no_auto_broadcast):
    resolve(facts, [Lookup(dim, {"id": "key"}, ["name"])], 0, hot_rows=1000).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan
    assert "SPARK_PARTITION_ID" not in plan


def test_hot_and_null_keys_are_spread(spark, facts, dim, no_auto_broadcast):
    salted = resolve(facts, [Lookup(dim, {"k": "key"}, ["name"])], 0, hot_rows=1000)
    # The join output keeps the shuffle's partitions: none may hold one whole key.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = salted.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8
    assert max(row["count"] for row in sizes) < 30_000 / 8 * 1.5


def test_exact_copies_are_spread(spark, no_auto_broadcast):
    copies = spark.range(0, 16_000, 1, 200).select(F.lit(7).cast("long").alias("k"))
    dim = spark.range(10).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    salted = resolve(copies, [Lookup(dim, {"k": "key"}, ["name"])], 0, hot_rows=1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = salted.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8
    assert max(row["count"] for row in sizes) < 16_000 / 8 * 1.6
    assert salted.where("name = 'x'").count() == 16_000


def test_plan_follows_the_measured_size(facts, dim, no_auto_broadcast, capsys):
    resolve(facts, [Lookup(dim, {"k": "key"}, ["name"])]).explain()
    assert "SortMergeJoin" not in capsys.readouterr().out
    resolve(facts, [Lookup(dim, {"k": "key"}, ["name"])], broadcast_bytes=1000).explain()
    assert "SortMergeJoin" in capsys.readouterr().out


def test_salting_reads_no_further_columns(spark, facts, dim, scratch, capsys, no_auto_broadcast):
    facts.withColumn("unused", F.lit("x")).coalesce(1).write.parquet(f"{scratch}/f")
    stored = spark.read.parquet(f"{scratch}/f")
    found = resolve(stored, [Lookup(dim, {"k": "key"}, ["name"])], 0, hot_rows=1000)
    found.groupBy("name").count().explain()
    assert "ReadSchema: struct<k:bigint>" in capsys.readouterr().out


def test_size_counts_text(spark):
    texts = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast([texts, spark.range(100)], limit=50_000) == [False, True]


def test_composite_and_mixed_width_keys(spark, no_auto_broadcast):
    facts = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "x INT, y STRING")
    keys_of = spark.range(10).select(F.lit(1).alias("x"), F.lit("a").alias("y"))
    dim = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (2**40, "a", 30), (1, None, 40)], "dx LONG, dy STRING, v INT"
    )
    lookup = Lookup(dim, {"x": "dx", "y": "dy"}, ["v"], keys_from=keys_of)
    for limit, hot_rows in ((0, 5), (0, 10**9), (10**6, 5)):
        found = resolve(facts, [lookup], limit, hot_rows).collect()
        assert sorted(row["v"] or 0 for row in found) == [0, 10, 20]


def test_repeated_keys_and_wrong_types_raise(spark, facts):
    twice = spark.range(5).union(spark.range(1)).select(F.col("id").alias("key"), F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="multiply"):
        resolve(facts, [Lookup(twice, {"k": "key"}, ["v"], check_unique=True)])
    text = twice.withColumn("key", F.col("key").cast("string"))
    with pytest.raises(TypeError, match="cast"):
        resolve(facts, [Lookup(text, {"k": "key"}, ["v"])])


@pytest.mark.parametrize("hot_bytes", [lookup.HOT_BYTES, 0])
def test_repeated_vouched_keys_have_one_outcome(spark, facts, monkeypatch, hot_bytes):
    monkeypatch.setattr(lookup, "HOT_BYTES", hot_bytes)
    twice = spark.createDataFrame([(7, 1), (7, 2)], "key LONG, v LONG")
    many = [Lookup(twice, {"k": "key"}, ["v"], skewed=True)]
    ways = [
        sorted(map(tuple, resolve(facts, many, limit, hot_rows=1000).groupBy("k", "v").count().collect()), key=repr)
        for limit in (1 << 26, 0)
    ]
    assert ways[0] == ways[1]
    refused = [Lookup(twice, {"k": "key"}, ["v"], check_unique=True)]
    for limit in (1 << 26, 0):
        with pytest.raises(ValueError, match="multiply"):
            resolve(facts, refused, limit, hot_rows=1000)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1000, 10**9])
def test_a_task_hashes_a_small_share_and_does_not_sort(spark, facts, dim, how, hot_rows, no_auto_broadcast, capsys):
    twice = dim.unionByName(dim.where("key % 5 = 0")).unionByName(dim.selectExpr("cast(null as long) as key", "name"))
    limit = 4 * (40 * twice.count() // int(spark.conf.get("spark.sql.shuffle.partitions")))
    joined = resolve(facts, [Lookup(twice, {"k": "key"}, ["name"], how)], limit, hot_rows)
    joined.explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(joined) == rows(facts.join(twice, facts.k == twice.key, how).drop("key"))
