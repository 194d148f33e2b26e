"""Lookups of columns from tables that hold one row per key.

A star-schema load is a chain of lookups from a very large table into smaller
ones, on keys of which a few may own most of the rows. The join strategy is
picked from what is measured, not assumed:

* a looked-up table within ``broadcast_bytes`` is broadcast, so the large table
  never moves;
* a bigger one is joined by shuffle: hashed where a task's share of it is within
  half of ``broadcast_bytes``, so that the large table is not sorted, which takes
  a task several times that memory, and else as Spark will, by sort and merge.
  Keys that own a large share of the rows are found first. Each of these, and NULL,
  would land in one task, so they are spread over all tasks by a salt and take
  their columns from a broadcast of just those keys' rows, at most
  ``MAX_HOT_KEYS`` if keys are unique, and measured before.
  Adaptive execution splits whatever skew is left.

Every row of the large table comes out under either strategy.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# Keys with fewer rows, or a smaller share of them, are left to the shuffle.
HOT_ROWS = 100_000
HOT_SHARE = 1e-3
# So there cannot be more keys with that share than this.
MAX_HOT_KEYS = 1000
# Their rows are broadcast up to this size.
HOT_BYTES = 64 * 1024 * 1024
# Counters of the frequent-item sketch: its error stays below HOT_SHARE. Tasks'
# sketches are merged in this many groups first, not all in one task.
SKETCH_COUNTERS = 8192
SKETCH_GROUPS = 256
# Row header plus hash-map entry of a broadcast row, and one field slot.
ROW_BYTES = 32
SLOT_BYTES = 8

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Skew:
    """Hashes of the keys that own many rows, and whether NULL is one of them."""

    keys: tuple[int, ...] = ()
    nulls: bool = False


@dataclass(frozen=True)
class Lookup:
    """What to fetch from ``table``, which has at most one row per key.

    ``on`` maps columns of the large table to key columns of ``table``;
    ``take`` names the columns to bring over. ``skewed`` is False if the large
    table, too, has one row per key. Repeated keys raise if ``check_unique``;
    else the caller vouches for them, and rows of a key that repeats after all
    are multiplied, whichever way the tables are joined.

    ``keys_from`` is a frame to look for frequent keys in, under the large
    table's column names, for when that is itself a join too dear to run twice.
    """

    table: DataFrame
    on: Mapping[str, str]
    take: Sequence[str] = ()
    how: str = "left"
    skewed: bool = True
    check_unique: bool = False
    keys_from: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.how not in ("left", "inner"):
            raise ValueError(f"a lookup is left or inner, not {self.how}")

    def pruned(self) -> DataFrame:
        """Only the key and the fetched columns."""
        return self.table.select(*dict.fromkeys([*self.on.values(), *self.take]))


def resolve(
    rows: DataFrame,
    lookups: Sequence[Lookup],
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``rows`` with the fetched columns of every lookup appended.

    The limits are ``BROADCAST_BYTES`` and ``HOT_ROWS`` unless given.
    """
    broadcast_bytes = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    for lookup in lookups:
        _check(rows, lookup)
    sizes = _sizes(lookups)
    small = [size <= broadcast_bytes for size in sizes]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    skews = _skews(rows, [lk for lk, fits in zip(lookups, small) if lk.skewed and not fits], hot_rows)
    for lookup, fits, size in zip(lookups, small, sizes):
        skew = skews.get(id(lookup), Skew())
        hint = "broadcast" if fits else "shuffle_hash" if size <= broadcast_bytes // 2 * tasks else None
        if skew == Skew():
            rows = _plain_join(rows, lookup, hint)
        else:
            rows = _salted_join(rows, lookup, skew, hint)
    return rows


def fits_broadcast(tables: Sequence[DataFrame], limit: int | None = None) -> list[bool]:
    """Measure each table's in-memory size, all in one job, against ``limit``.

    Rows are counted; only columns of varying length are read for their size.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    return [size <= limit for size, _ in _measured([(table, ()) for table in tables])]


def find_skew(
    rows: DataFrame, key_lists: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS
) -> list[Skew]:
    """The key values that own a large share of ``rows``, for each of several keys.

    One scan of the key columns feeds mergeable frequent-item sketches, so no
    key is shuffled. The sketch only steers the physical plan: a key missed or
    named in error changes no result.
    """
    count = range(len(key_lists))
    hashes = [_key_hash(keys).alias(f"h{i}") for i, keys in enumerate(key_lists)]
    grouped = rows.select(
        *hashes, F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    ).groupBy("g")
    partial = grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"h{i}").isNull()).alias(f"nulls{i}") for i in count],
        *[_sketch("accumulate", f"h{i}", SKETCH_COUNTERS).alias(f"s{i}") for i in count],
    )
    merged = partial.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.sum(f"nulls{i}").alias(f"nulls{i}") for i in count],
        *[_sketch("combine", f"s{i}", SKETCH_COUNTERS).alias(f"s{i}") for i in count],
    )
    found = merged.select(
        "rows",
        *[f"nulls{i}" for i in count],
        *[_sketch("estimate", f"s{i}", MAX_HOT_KEYS).alias(f"top{i}") for i in count],
    ).head()
    floor = max(hot_rows, found["rows"] * HOT_SHARE)
    skews = []
    for i in count:
        often = [item["item"] for item in found[f"top{i}"] or [] if item["count"] >= floor]
        nulls = (found[f"nulls{i}"] or 0) >= floor
        skews.append(Skew(tuple(key for key in often if key is not None), nulls))
    return skews


def _sketch(step: str, column: str, size: int) -> Column:
    return F.expr(f"approx_top_k_{step}({column}, {size})")


def _skews(rows: DataFrame, lookups: Sequence[Lookup], hot_rows: int) -> dict[int, Skew]:
    """Skew of each lookup by its id; those read from ``rows`` share one scan."""
    skews = {}
    shared = [lookup for lookup in lookups if lookup.keys_from is None]
    apart = [[lookup] for lookup in lookups if lookup.keys_from is not None]
    for group in [shared, *apart]:
        if group:
            source = rows
            if group is not shared:
                # Hashes only compare between values of one type.
                source = group[0].keys_from.select(
                    *[F.col(key).cast(rows.schema[key].dataType).alias(key) for key in group[0].on]
                )
            found = find_skew(source, [list(lookup.on) for lookup in group], hot_rows)
            skews.update((id(lookup), skew) for lookup, skew in zip(group, found))
    return skews


def _check(rows: DataFrame, lookup: Lookup) -> None:
    clash = set(rows.columns) & set(lookup.take)
    if clash:
        raise ValueError(f"looked-up columns exist already: {sorted(clash)}")
    for left, right in lookup.on.items():
        kinds = rows.schema[left].dataType, lookup.table.schema[right].dataType
        if kinds[0] != kinds[1] and not all(isinstance(kind, _INTEGERS) for kind in kinds):
            raise TypeError(f"{left} is {kinds[0]} but {right} is {kinds[1]}; cast one of them")


def _sizes(lookups: Sequence[Lookup]) -> list[int]:
    """Bytes of each looked-up table; raises where keys repeat."""
    measured = _measured(
        [(lk.pruned(), tuple(lk.on.values()) if lk.check_unique else ()) for lk in lookups]
    )
    for lookup, (_, repeats) in zip(lookups, measured):
        if repeats > 1:
            raise ValueError(
                f"one value of {list(lookup.on.values())} has {repeats} rows to look up, "
                "which would multiply the rows that hold it"
            )
    return [size for size, _ in measured]


def _measured(tables: Sequence[tuple[DataFrame, tuple[str, ...]]]) -> list[tuple[int, int]]:
    """Bytes of each table and, if keys are given, most rows with one key; in one job."""
    if not tables:
        return []
    parts = []
    for position, (table, keys) in enumerate(tables):
        if keys:
            per_key = table.groupBy(*keys).agg(
                _bytes(table).alias("bytes"), F.count(F.lit(1)).alias("n")
            )
            known = reduce(and_, [F.col(key).isNotNull() for key in keys])
            repeats = F.max(F.when(known, F.col("n")))
            part = per_key.agg(F.sum("bytes").alias("bytes"), repeats.alias("repeats"))
        else:
            part = table.agg(_bytes(table).alias("bytes"), F.lit(0).cast("long").alias("repeats"))
        parts.append(part.withColumn("position", F.lit(position)))
    found = {row["position"]: row for row in reduce(DataFrame.unionByName, parts).collect()}
    return [(found[i]["bytes"] or 0, found[i]["repeats"] or 0) for i in range(len(tables))]


def _bytes(table: DataFrame) -> Column:
    """Aggregate giving the bytes of ``table`` as rows of a broadcast."""
    fixed = ROW_BYTES + SLOT_BYTES * len(table.columns)
    size = F.count(F.lit(1)) * F.lit(fixed)
    for column in table.schema.fields:
        kind = column.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            length = F.octet_length(column.name)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            length = F.octet_length(F.to_json(F.struct(column.name)))
        else:
            continue
        size = size + F.coalesce(F.sum(length.cast("long")), F.lit(0))
    return size


def _key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key, NULL for a key that can match nothing."""
    known = reduce(and_, [F.col(key).isNotNull() for key in keys])
    return F.when(known, F.xxhash64(*[F.col(key) for key in keys]))


def _renamed(lookup: Lookup, rows: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The looked-up table with key columns named apart from the large one's."""
    pairs = [(left, f"__key_{i}") for i, left in enumerate(lookup.on)]
    keys = [
        _key_as(F.col(right), lookup.table.schema[right].dataType, rows.schema[left].dataType)
        .alias(name)
        for (left, name), right in zip(pairs, lookup.on.values())
    ]
    return lookup.pruned().select(*keys, *lookup.take), pairs


def _key_as(key: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    # An integer too wide for the other side equals none of its values.
    return key if kind == wanted else key.try_cast(wanted)


def _hinted(table: DataFrame, hint: str | None) -> DataFrame:
    return table.hint(hint) if hint else table


def _plain_join(rows: DataFrame, lookup: Lookup, hint: str | None) -> DataFrame:
    table, pairs = _renamed(lookup, rows)
    matches = reduce(and_, [F.col(left) == F.col(name) for left, name in pairs])
    return rows.join(_hinted(table, hint), matches, lookup.how).drop(*[name for _, name in pairs])


def _salted_join(rows: DataFrame, lookup: Lookup, skew: Skew, hint: str | None) -> DataFrame:
    table, pairs = _renamed(lookup, rows)
    keys, names = [left for left, _ in pairs], [name for _, name in pairs]

    # Rows that the shuffle cannot or need not match are salted by the input
    # partition they are in. That is the same when a lost task is redone, needs
    # no other column, and divides even exact copies of one row: a task gets
    # such rows in portions of an input partition. The salt joins as a hash
    # with the key: a constant on the table's side would be folded out of the
    # join keys, and the hot rows sent to one task after all.
    alone = reduce(or_, [F.col(key).isNull() for key in keys])
    if skew.keys:
        alone = alone | _key_hash(keys).isin(*skew.keys)
    unsalted = F.lit(0)
    salt = F.when(alone, F.spark_partition_id() + 1).otherwise(unsalted)
    salted = rows.withColumn("__at", F.xxhash64(*[F.col(key) for key in keys], salt))
    cold = table.select(
        *[F.col(name).alias(f"__cold_{name}") for name in names],
        F.xxhash64(*[F.col(name) for name in names], unsalted).alias("__cold_at"),
        *[F.col(column).alias(f"__cold_{column}") for column in lookup.take],
    )
    matches = [F.col(key) == F.col(f"__cold_{name}") for key, name in zip(keys, names)]
    joined = salted.join(_hinted(cold, hint), reduce(and_, matches) & (F.col("__at") == F.col("__cold_at")), "left")
    found = F.col("__cold_at").isNotNull()
    fetched = {column: F.col(f"__cold_{column}") for column in lookup.take}
    if skew.keys:
        few = table.where(_key_hash(names).isin(*skew.keys)).select(
            *names, *[F.col(column).alias(f"__hot_{column}") for column in lookup.take]
        )
        if not fits_broadcast([few], HOT_BYTES)[0]:
            # Wide rows, or repeated keys of a table whose caller vouched for it.
            return _plain_join(rows, lookup, None)
        matches = [F.col(key) == F.col(name) for key, name in zip(keys, names)]
        joined = joined.join(F.broadcast(few), reduce(and_, matches), "left")
        found = found | F.col(names[0]).isNotNull()
        fetched = {c: F.coalesce(F.col(f"__hot_{c}"), cold_c) for c, cold_c in fetched.items()}
    if lookup.how == "inner":
        joined = joined.where(found)
    return joined.select(*rows.columns, *[value.alias(c) for c, value in fetched.items()])

