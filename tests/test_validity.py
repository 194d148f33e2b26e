from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import resolve_valid

VERSIONS = "k long, valid_from date, valid_to date, name string, note string"
FACTS = "id long, k long, day date"
DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def history(seed):
    """Versions of 30 keys with gaps between some, open and NULL ends."""
    rng, out = random.Random(seed), []
    for key in range(30):
        at = rng.randrange(-50, 400)
        for n in range(rng.randrange(6)):
            end = at + rng.choice([0, 1, 40, 700])
            out.append((key, day(at), day(end), f"{key}-{n}", rng.choice([None, "x"])))
            at = end + rng.choice([1, 1, 20])
        out.append((key, day(at), rng.choice([None, dt.date(9999, 12, 31)]), f"{key}-last", None))
    return out


def facts(seed, n=3000):
    """A third of the rows on one key; unknown and NULL keys and days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if i % 3 == 0 else rng.choice([None, *range(35)])
        rows.append((i, key, rng.choice([None, day(rng.randrange(-100, 2500))])))
    return rows


def brute(rows, versions):
    out = []
    for i, key, at in rows:
        valid = [
            v for v in versions if key is not None and v[0] == key and at and v[1] <= at <= (v[2] or dt.date.max)
        ]
        assert len(valid) <= 1
        out.append((i, key, at, *(valid[0][3:] if valid else (None, None))))
    return out


@pytest.mark.parametrize("bin_days", [1, 30, 366])
@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "hot_rows": 100}])
def test_equals_brute_force(spark, bin_days, limits):
    versions, rows = history(1), facts(2)
    found = resolve_valid(
        spark.createDataFrame(rows, FACTS), spark.createDataFrame(versions, VERSIONS),
        "k", "day", ["name", "note"], bin_days=bin_days, **limits,
    )
    assert found.columns == ["id", "k", "day", "name", "note"]
    assert sorted(found.collect()) == sorted(brute(rows, versions), key=lambda r: r[0])


def test_inner_keeps_rows_with_a_version(spark):
    versions, rows = history(3), facts(4)
    args = spark.createDataFrame(versions, VERSIONS).withColumnRenamed("k", "key"), "k", "day", ["name"]
    found = resolve_valid(spark.createDataFrame(rows, FACTS), *args, version_key="key", how="inner")
    expected = [r[:4] for r in brute(rows, versions) if r[3] is not None]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_empty_tables_and_rows_without_days(spark):
    versions = spark.createDataFrame(history(5), VERSIONS)
    none = spark.createDataFrame([], FACTS)
    assert resolve_valid(none, versions, "k", "day", ["name"]).collect() == []
    undated = spark.createDataFrame([(1, 7, None), (2, None, day(5))], FACTS)
    assert {r.name for r in resolve_valid(undated, versions, "k", "day", ["name"]).collect()} == {None}
    dated = spark.createDataFrame([(1, 7, day(5))], FACTS)
    (row,) = resolve_valid(dated, versions.limit(0), "k", "day", ["name"]).collect()
    assert row.name is None


def test_overlaps_raise_and_empty_intervals_do_not(spark):
    dated = spark.createDataFrame([(1, 7, day(5))], FACTS)
    twice = spark.createDataFrame([(7, day(0), day(9), "a", None), (7, day(9), None, "b", None)], VERSIONS)
    with pytest.raises(Exception, match="overlap"):
        resolve_valid(dated, twice, "k", "day", ["name"]).collect()
    void = [(7, day(0), day(9), "a", None), (7, day(5), day(4), "b", None), (7, None, day(9), "c", None)]
    (row,) = resolve_valid(dated, spark.createDataFrame(void, VERSIONS), "k", "day", ["name"]).collect()
    assert row.name == "a"


def test_clashing_columns_raise(spark):
    dated = spark.createDataFrame([(1, 7, day(5))], FACTS).withColumn("name", F.lit("x"))
    with pytest.raises(ValueError, match="name"):
        resolve_valid(dated, spark.createDataFrame(history(1), VERSIONS), "k", "day", ["name"])


def test_no_nested_loop(spark):
    rows = spark.createDataFrame(facts(1), FACTS)
    found = resolve_valid(rows, spark.createDataFrame(history(1), VERSIONS), "k", "day", ["name"], broadcast_bytes=0)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
