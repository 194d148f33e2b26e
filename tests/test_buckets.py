from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom.operators import buckets
from starloom.operators.buckets import BucketLoad, create_buckets, load_buckets, read_buckets, superseded
from starloom.operators.scd2 import ScdSpec, initial_dimension, scd2_apply

SPEC = ScdSpec(rename={"id": "key", "name": "name", "tier": "tier", "town": "town"}, key="key", tracked=("tier", "town"))
SCHEMA = "id LONG, name STRING, tier INT, town STRING"
DAYS = [dt.date(2024, month, 1) for month in range(1, 6)]
KEYS = 600


def plain(spark, n=KEYS):
    return spark.range(n).select(
        "id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 3).cast("int").alias("tier"),
        F.when(F.col("id") % 5 > 0, F.lit("x")).alias("town"),
    )


def changed(snapshot, keys):
    return snapshot.withColumn("tier", F.when(F.col("id").isin(keys), 99).otherwise(F.col("tier")))


def rows(dim):
    return sorted(map(tuple, dim.select(*SPEC.columns).collect()))


def files(path):
    return {p for p in path.rglob("*.parquet")}


def stored(spark, folder, count=12, n=KEYS):
    dim = initial_dimension(plain(spark, n), SPEC, DAYS[0])
    return dim, create_buckets(dim, str(folder), SPEC, count, DAYS[0])


def test_loads_equal_the_plain_ones(spark, tmp_path):
    dim, store = stored(spark, tmp_path / "d")
    assert rows(read_buckets(spark, store)) == rows(dim)
    feb = changed(plain(spark, KEYS + 30), [5, 6, 599])
    mar = changed(feb, [6, 7]).where("id <> 5").withColumn("name", F.lit("renamed"))
    for day, snapshot in zip(DAYS[1:], (feb, mar)):
        dim = scd2_apply(dim, snapshot, SPEC, day)
        load_buckets(spark, store, snapshot, day)
        assert rows(read_buckets(spark, store)) == rows(dim)


def test_a_load_writes_only_buckets_with_changes(spark, tmp_path):
    _, store = stored(spark, tmp_path / "d")
    before = files(tmp_path / "d" / "rows")
    assert load_buckets(spark, store, plain(spark), DAYS[1]) == BucketLoad(12, 0, 0)
    assert files(tmp_path / "d" / "rows") == before
    keys = list(range(0, KEYS, 300))
    done = load_buckets(spark, store, changed(plain(spark), keys), DAYS[1])
    assert done.read == done.written <= len(keys)
    added = files(tmp_path / "d" / "rows") - before
    assert before <= files(tmp_path / "d" / "rows")
    assert {p.parents[2].name for p in added} == {"is_current=true", "is_current=false"}
    assert len({p.parent for p in added}) == 2 * done.written
    assert superseded(spark, store).count() == done.written


def test_equal_buckets_are_not_read(spark, tmp_path, monkeypatch):
    _, store = stored(spark, tmp_path / "d")
    read = []
    apply = buckets.scd2_apply

    def seen(dim, snapshot, *rest, **named):
        read.append((dim.inputFiles(), snapshot.count()))
        return apply(dim, snapshot, *rest, **named)

    monkeypatch.setattr(buckets, "scd2_apply", seen)
    load_buckets(spark, store, changed(plain(spark), [3]), DAYS[1])
    (names, count), = read
    assert len({n.rsplit("/", 1)[0] for n in names}) == 1 and 0 < count < KEYS / 4


def test_a_snapshot_of_some_keys_leaves_other_buckets(spark, tmp_path):
    dim, store = stored(spark, tmp_path / "d")
    some = changed(plain(spark), [11, 12]).where("id in (11, 12, 13)")
    done = load_buckets(spark, store, some, DAYS[1])
    assert done.written <= 2 and done.reached <= 3
    assert rows(read_buckets(spark, store)) == rows(scd2_apply(dim, some, SPEC, DAYS[1]))


def test_a_null_that_moves_between_columns_is_a_change(spark, tmp_path):
    spec = replace(SPEC, rename={"id": "key", "a": "a", "b": "b"}, tracked=("a", "b"))
    make = lambda a, b: spark.createDataFrame([(1, a, b)], "id LONG, a STRING, b STRING")
    store = create_buckets(initial_dimension(make("x", None), spec, DAYS[0]), str(tmp_path / "d"), spec, 4, DAYS[0])
    assert load_buckets(spark, store, make(None, "x"), DAYS[1]).written == 1
    assert read_buckets(spark, store).count() == 2


def test_repeated_and_broken_loads(spark, tmp_path, monkeypatch):
    dim, store = stored(spark, tmp_path / "d", 8)
    feb = changed(plain(spark, KEYS + 9), list(range(40)))
    want = scd2_apply(dim, feb, SPEC, DAYS[1])
    # The load ends with half of its buckets in place and no digest of them.
    write, note = buckets._write, buckets._note_digests

    def half(placed, store, day):
        write(placed.where(F.col(buckets.BUCKET) % 2 == 0), store, day)
        raise RuntimeError("lost")

    monkeypatch.setattr(buckets, "_write", half)
    with pytest.raises(RuntimeError, match="lost"):
        load_buckets(spark, store, feb, DAYS[1])
    monkeypatch.setattr(buckets, "_write", write)
    load_buckets(spark, store, feb, DAYS[1])
    without = lambda d: sorted(map(tuple, d.select(*SPEC.columns[1:]).collect()))
    got = read_buckets(spark, store)
    assert without(got) == without(want)
    assert got.select(SPEC.sk).distinct().count() == got.count()
    assert load_buckets(spark, store, feb, DAYS[1]) == BucketLoad(8, 0, 0)


def test_refusals(spark, tmp_path):
    _, store = stored(spark, tmp_path / "d", 4, 50)
    twice = changed(plain(spark, 50), [3])
    with pytest.raises(ValueError, match="occurs up to 2"):
        load_buckets(spark, store, twice.union(twice.where("id = 3")), DAYS[1])
    with pytest.raises(ValueError, match="NULL in 1"):
        load_buckets(spark, store, twice.union(spark.sql("select cast(null as long), 'a', 1, 'b'")), DAYS[1])
    load_buckets(spark, store, twice, DAYS[2])
    with pytest.raises(ValueError, match="later"):
        load_buckets(spark, store, plain(spark, 50), DAYS[1])
    with pytest.raises(ValueError, match="4"):
        load_buckets(spark, replace(store, buckets=8), plain(spark, 50), DAYS[3])


def test_from_and_to_nothing(spark, tmp_path):
    none = plain(spark).limit(0)
    _, store = stored(spark, tmp_path / "d", 4, 0)
    assert read_buckets(spark, store).count() == 0
    assert load_buckets(spark, store, none, DAYS[1]) == BucketLoad(0, 0, 0)
    load_buckets(spark, store, plain(spark, 10), DAYS[1])
    assert load_buckets(spark, store, none, DAYS[2]) == BucketLoad(0, 0, 0)
    assert [r[0] for r in rows(read_buckets(spark, store))] == list(range(1, 11))
