from __future__ import annotations

import datetime as dt

import pytest

from starloom.operators import scd2
from starloom.operators.scd2 import ScdSpec
from starloom.sources import read_dimension, save_dimension, write_dimension

SPEC = ScdSpec(
    rename={
        "c_custkey": "customer_key",
        "c_name": "customer_name",
        "c_address": "customer_address",
        "c_phone": "customer_phone",
        "c_acctbal": "customer_account_balance",
    },
    key="customer_key",
    tracked=("customer_address", "customer_phone", "customer_account_balance"),
)
SCHEMA = (
    "c_custkey INT, c_name STRING, c_address STRING, c_phone STRING, c_acctbal DOUBLE, "
    "snapshot_date DATE"
)
JAN, FEB, MAR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def snapshot(spark, day, *rows):
    return spark.createDataFrame([(*row, day) for row in rows], SCHEMA)


@pytest.fixture()
def jan(spark):
    return snapshot(
        spark, JAN,
        (1, "a", "x", "p", 1.0), (2, "b", "x", None, 2.0), (3, "c", "x", "p", 3.0),
        (27, "d", None, "p", 4.0),
    )


@pytest.fixture()
def feb(spark):
    """1 same, 2 gets a phone, 3 is absent, 27 only renamed, 40 new."""
    return snapshot(
        spark, FEB,
        (1, "a", "x", "p", 1.0), (2, "b", "x", "q", 2.0), (27, "renamed", None, "p", 4.0),
        (40, "e", "y", "p", 5.0),
    )


@pytest.fixture()
def mar(spark):
    """1 loses its address, 2 changes again, 3 is back as it was, 40 is absent."""
    return snapshot(
        spark, MAR,
        (1, "a", None, "p", 1.0), (2, "b", "z", "q", 2.5), (3, "c", "x", "p", 3.0),
        (27, "renamed", None, "p", 4.0),
    )


def by_version(dim):
    rows = dim.orderBy("customer_key", "valid_from").collect()
    return {(r["customer_key"], r["valid_from"]): r for r in rows}


def check_invariants(dim):
    rows = dim.orderBy("customer_key", "valid_from").collect()
    assert sorted(r["customer_sk"] for r in rows) == list(range(1, len(rows) + 1))
    for key in {r["customer_key"] for r in rows}:
        versions = [r for r in rows if r["customer_key"] == key]
        assert [r["is_current"] for r in versions].count(True) == 1
        assert versions[-1]["valid_to"] == dt.date(9999, 12, 31)
        for old, new in zip(versions, versions[1:]):
            assert old["valid_to"] == new["valid_from"] - dt.timedelta(days=1)


def test_initial_dimension(jan):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    assert dim.columns == SPEC.columns
    assert [r["customer_sk"] for r in dim.orderBy("customer_key").collect()] == [1, 2, 3, 4]
    assert dim.where("is_current").count() == 4
    check_invariants(dim)


def test_changes_are_null_safe(jan, feb):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    classified = scd2.classify_changes(feb, dim, SPEC)
    labels = {r["customer_key"]: r["change"] for r in classified.collect()}
    assert labels == {1: "Unchanged", 2: "Changed", 27: "Unchanged", 40: "New"}
    assert [r["customer_key"] for r in scd2.new_rows(classified).collect()] == [40]


def test_only_current_versions_are_compared(jan, feb, mar):
    dim = scd2.scd2_apply(scd2.initial_dimension(jan, SPEC, JAN), feb, SPEC, FEB)
    classified = scd2.classify_changes(mar, dim, SPEC)
    assert classified.count() == mar.count()
    labels = {r["customer_key"]: r["change"] for r in classified.collect()}
    assert labels == {1: "Changed", 2: "Changed", 3: "Unchanged", 27: "Unchanged"}


def test_apply_keeps_absent_rows_and_history(jan, feb, mar):
    first = scd2.initial_dimension(jan, SPEC, JAN)
    second = scd2.scd2_apply(first, feb, SPEC, FEB)
    third = scd2.scd2_apply(second, mar, SPEC, MAR)
    for dim, versions in ((second, 6), (third, 8)):
        check_invariants(dim)
        assert dim.count() == versions
    assert {r[0] for r in third.select("customer_key").collect()} == {1, 2, 3, 27, 40}
    rows = by_version(third)
    assert [k for k in rows if k[0] == 2] == [(2, JAN), (2, FEB), (2, MAR)]
    assert rows[2, JAN]["valid_to"] == dt.date(2024, 1, 31)
    assert rows[1, MAR]["customer_address"] is None
    assert rows[27, JAN]["customer_name"] == "d"


def test_apply_is_the_sum_of_its_parts(jan, feb):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    classified = scd2.classify_changes(feb, dim, SPEC)
    parts = (
        scd2.expire_changed(classified, SPEC, FEB)
        .unionByName(scd2.carry_unchanged(dim, classified, SPEC))
        .unionByName(
            scd2.build_inserts(classified, SPEC, FEB, scd2.max_key(dim, SPEC.sk))
        )
    )
    assert by_version(parts) == by_version(scd2.scd2_apply(dim, feb, SPEC, FEB))


def test_same_feed_twice_changes_nothing(jan, feb):
    once = scd2.scd2_apply(scd2.initial_dimension(jan, SPEC, JAN), feb, SPEC, FEB)
    twice = scd2.scd2_apply(once, feb, SPEC, MAR)
    assert by_version(twice) == by_version(once)


def test_date_of_the_snapshot_by_default(jan, feb):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    assert by_version(scd2.scd2_apply(dim, feb, SPEC)) == by_version(
        scd2.scd2_apply(dim, feb, SPEC, FEB)
    )


def test_replay_equals_loading_one_by_one(jan, feb, mar):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    for day, feed in ((FEB, feb), (MAR, mar)):
        dim = scd2.scd2_apply(dim, feed, SPEC, day)
    replayed = scd2.scd2_replay([(JAN, jan), (FEB, feb), (MAR, mar)], SPEC)
    assert by_version(replayed) == by_version(dim)


@pytest.mark.parametrize("partitions", [1, 17])
def test_result_does_not_depend_on_partitions(spark, jan, feb, partitions):
    dim = scd2.initial_dimension(jan.repartition(partitions), SPEC, JAN)
    loaded = scd2.scd2_apply(dim, feb.repartition(partitions), SPEC, FEB)
    plain = scd2.scd2_apply(scd2.initial_dimension(jan, SPEC, JAN), feb, SPEC, FEB)
    assert by_version(loaded) == by_version(plain)


def test_bad_business_keys_raise(spark, jan):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    twice = snapshot(spark, FEB, (9, "x", "x", "p", 1.0), (9, "y", "y", "p", 1.0))
    unkeyed = snapshot(spark, FEB, (None, "x", "x", "p", 1.0))
    for feed in (twice, unkeyed):
        with pytest.raises(ValueError, match="business key"):
            scd2.scd2_apply(dim, feed, SPEC, FEB)
        with pytest.raises(ValueError, match="business key"):
            scd2.initial_dimension(feed, SPEC, FEB)
        with pytest.raises(ValueError, match="business key"):
            scd2.scd2_replay([(JAN, jan), (FEB, feed)], SPEC)


def test_history_of_one_key(jan, feb, mar):
    dim = scd2.scd2_replay([(JAN, jan), (FEB, feb), (MAR, mar)], SPEC)
    assert [r["valid_from"] for r in scd2.key_history(dim, SPEC, 2).collect()] == [JAN, FEB, MAR]
    assert scd2.current_rows(dim).count() == 5


def test_large_dimension_path(spark, jan, feb, monkeypatch):
    """Changed keys too many to broadcast are joined by shuffle, to the same end."""
    from starloom.operators import lookup

    dim = scd2.initial_dimension(jan, SPEC, JAN)
    expected = by_version(scd2.scd2_apply(dim, feb, SPEC, FEB))
    monkeypatch.setattr(
        scd2, "resolve", lambda rows, lookups: lookup.resolve(rows, lookups, broadcast_bytes=0)
    )
    assert by_version(scd2.scd2_apply(dim, feb, SPEC, FEB)) == expected


def test_dimension_on_disk(spark, jan, feb, scratch, capsys):
    write_dimension(scd2.initial_dimension(jan, SPEC, JAN), f"{scratch}/v1")
    stored = read_dimension(spark, f"{scratch}/v1")
    write_dimension(scd2.scd2_apply(stored, feb, SPEC, FEB), f"{scratch}/v2")
    read = read_dimension(spark, f"{scratch}/v2").select(*SPEC.columns)
    check_invariants(read)
    with pytest.raises(Exception, match="already exists"):
        write_dimension(read, f"{scratch}/v2")
    assert scd2.current_rows(read).count() == 5
    scd2.current_rows(read).explain()
    assert "PartitionFilters: [isnotnull(is_current" in capsys.readouterr().out


def test_bucketed_dimension_is_not_shuffled(spark, jan, feb, capsys):
    spark.sql("create database if not exists dims")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_dimension(scd2.initial_dimension(jan, SPEC, JAN), "dims.v1", SPEC.key, 4)
        stored = spark.table("dims.v1")
        loaded = by_version(scd2.scd2_apply(stored, feb, SPEC, FEB))
        assert loaded == by_version(
            scd2.scd2_apply(scd2.initial_dimension(jan, SPEC, JAN), feb, SPEC, FEB)
        )
        capsys.readouterr()
        scd2.classify_changes(feb, stored, SPEC).explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange hashpartitioning") == 1
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop database dims cascade")


def test_a_repeated_key_raises_also_where_one_row_is_unchanged(spark, jan):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    feed = snapshot(spark, FEB, (1, "a", "x", "p", 1.0), (1, "a", "y", "p", 1.0))
    with pytest.raises(ValueError, match="business key"):
        scd2.scd2_apply(dim, feed, SPEC, FEB)


@pytest.mark.parametrize("day", [JAN, dt.date(2023, 6, 1)])
def test_a_load_must_be_later_than_what_it_closes(jan, feb, day):
    dim = scd2.initial_dimension(jan, SPEC, JAN)
    with pytest.raises(ValueError, match="day of this load or later"):
        scd2.scd2_apply(dim, feb, SPEC, day)
    classified = scd2.classify_changes(feb, dim, SPEC)
    with pytest.raises(Exception, match="is not before"):
        scd2.expire_changed(classified, SPEC, day).collect()
