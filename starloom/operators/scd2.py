"""Slowly changing dimensions that keep every version of a row (type 2).

A dimension row has a surrogate key, a business key, attributes, a validity
interval ``valid_from``..``valid_to`` (both days included) and ``is_current``.
Each load compares a full snapshot with the current rows: new business keys and
changed attributes get a new version, the version they replace is closed, and
nothing is ever removed, also when a key is missing from the snapshot.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.compare import any_differs
from starloom.functions.dates import OPEN_END, as_date, date_column
from starloom.operators.keys import assign_surrogate_keys, max_key
from starloom.operators.lookup import Lookup, resolve
from starloom.sources.scratch import materialize

NEW, CHANGED, UNCHANGED = "New", "Changed", "Unchanged"
CONTROL = ("valid_from", "valid_to", "is_current")


@dataclass(frozen=True)
class ScdSpec:
    """How a snapshot becomes a dimension.

    ``rename`` maps snapshot columns to dimension columns; columns not named in
    it are not carried. ``key`` and ``tracked`` are dimension column names.
    """

    rename: Mapping[str, str]
    key: str
    tracked: Sequence[str]
    sk: str = "customer_sk"
    snapshot_date: str = "snapshot_date"

    @property
    def attributes(self) -> list[str]:
        return list(self.rename.values())

    @property
    def columns(self) -> list[str]:
        return [self.sk, *self.attributes, *CONTROL]


def conform(snapshot: DataFrame, spec: ScdSpec) -> DataFrame:
    """Snapshot columns under their dimension names."""
    return snapshot.withColumnsRenamed(dict(spec.rename)).select(*spec.attributes)


def initial_dimension(
    snapshot: DataFrame, spec: ScdSpec, valid_from: str | dt.date | Column, start: int = 0
) -> DataFrame:
    """First load: every row is a current version from ``valid_from`` on."""
    # Numbering samples its input first; written, the snapshot is run once.
    written = materialize(conform(snapshot, spec), "snapshot")
    numbered = assign_surrogate_keys(written, spec.key, start, spec.sk)
    _require_business_keys(numbered, [spec.key])
    return _opened(numbered, spec, valid_from)


def current_rows(dim: DataFrame) -> DataFrame:
    """The version of each key that is valid now."""
    return dim.where("is_current")


def key_history(dim: DataFrame, spec: ScdSpec, value: object) -> DataFrame:
    """All versions of one business key, oldest first."""
    return dim.where(F.col(spec.key) == F.lit(value)).orderBy("valid_from", spec.sk)


def classify_changes(snapshot: DataFrame, dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """Label each snapshot row ``New``, ``Changed`` or ``Unchanged``.

    Compared are the tracked attributes, null-safe, against the current version
    only. That version's columns come along as ``prev_*``; unused ones are
    pruned from the join. Both sides have one row per key, so the join strategy
    is left to Spark.
    """
    feed = conform(snapshot, spec)
    previous = current_rows(dim).select(
        *[F.col(name).alias(f"prev_{name}") for name in spec.columns]
    )
    differs = any_differs((F.col(name), F.col(f"prev_{name}")) for name in spec.tracked)
    change = (
        F.when(F.col(f"prev_{spec.key}").isNull(), NEW)
        .when(differs, CHANGED)
        .otherwise(UNCHANGED)
    )
    return feed.join(
        previous, F.col(spec.key) == F.col(f"prev_{spec.key}"), "left"
    ).withColumn("change", change)


def new_rows(classified: DataFrame) -> DataFrame:
    """Snapshot rows whose business key the dimension has not seen."""
    return classified.where(F.col("change") == NEW)


def expire_changed(
    classified: DataFrame, spec: ScdSpec, as_of: str | dt.date | Column
) -> DataFrame:
    """The versions that changed rows replace, closed the day before ``as_of``.

    A version that does not start before ``as_of`` cannot be closed so; it
    fails the query that reads it.
    """
    starts, day = F.col("prev_valid_from"), date_column(as_of)
    late = F.raise_error(F.concat(F.lit("a version from "), starts, F.lit(" is not before "), day))
    kept = [F.col(f"prev_{name}").alias(name) for name in (spec.sk, *spec.attributes, "valid_from")]
    return classified.where(F.col("change") == CHANGED).select(
        *kept,
        F.when(starts < day, F.date_sub(day, 1)).otherwise(late.cast("date")).alias("valid_to"),
        F.lit(False).alias("is_current"),
    )


def build_inserts(
    classified: DataFrame,
    spec: ScdSpec,
    as_of: str | dt.date | Column,
    max_sk: int | Column = 0,
) -> DataFrame:
    """New versions for new and changed rows, numbered on from ``max_sk``."""
    return _opened(_numbered_inserts(classified, spec, max_sk), spec, as_of)


def carry_unchanged(dim: DataFrame, classified: DataFrame, spec: ScdSpec) -> DataFrame:
    """Rows a load leaves as they are: closed versions, and current ones not changed.

    Only current rows take part in the anti join, so older versions of a key
    that changes again stay in the dimension.
    """
    changed = classified.where(F.col("change") == CHANGED).select(F.col(spec.key))
    dim = dim.select(*spec.columns)
    return dim.where("not is_current").unionByName(
        current_rows(dim).join(changed, spec.key, "left_anti")
    )


def scd2_apply(
    dim: DataFrame,
    snapshot: DataFrame,
    spec: ScdSpec,
    as_of: str | dt.date | Column | None = None,
    max_sk: int | Column | None = None,
) -> DataFrame:
    """The dimension after loading ``snapshot``; the same one if nothing changed.

    ``as_of`` is the first day of the new versions, by default the snapshot's
    own date. The classifying join runs once, when called, to write the new
    versions to scratch; it takes only key and tracked columns of the dimension.
    Current rows are then closed by looking the changed keys up in that written
    table: a broadcast when they are few, so that whole dimension rows are not
    shuffled. Closed versions are passed through.

    New versions are numbered on from ``max_sk``, by default ``dim``'s highest key.

    A business key that is NULL or repeats in the snapshot raises, and so does
    an ``as_of`` not after the first day of every version it would close.
    """
    _require_business_keys(conform(snapshot, spec), [spec.key])
    if as_of is None:
        as_of = snapshot.agg(F.max(spec.snapshot_date).cast("date")).scalar()
    classified = classify_changes(snapshot, dim, spec)
    start = max_key(dim, spec.sk) if max_sk is None else max_sk
    staged = _numbered_inserts(classified, spec, start, extra=["change", "prev_valid_from"])
    replacing = staged.where(F.col("change") == CHANGED)
    early = replacing.where(F.col("prev_valid_from") >= date_column(as_of))
    count, latest = early.agg(F.count(F.lit(1)), F.max("prev_valid_from")).head()
    if count:
        raise ValueError(f"{count} versions start on the day of this load or later, up to {latest}")

    replaced = staged.where(F.col("change") == CHANGED).select(
        F.col(spec.key).alias("__replaced"), F.lit(True).alias("__closes")
    )
    dim = dim.select(*spec.columns)
    closes = F.coalesce(F.col("__closes"), F.lit(False))
    current = resolve(
        current_rows(dim),
        [Lookup(replaced, {spec.key: "__replaced"}, ["__closes"], skewed=False)],
    ).withColumns(
        {
            "valid_to": F.when(closes, F.date_sub(date_column(as_of), 1)).otherwise(
                F.col("valid_to")
            ),
            "is_current": ~closes,
        }
    )
    return (
        dim.where("not is_current")
        .unionByName(current.select(*spec.columns))
        .unionByName(_opened(staged, spec, as_of))
    )


def scd2_replay(
    snapshots: Sequence[tuple[str | dt.date, DataFrame]], spec: ScdSpec, start: int = 0
) -> DataFrame:
    """The dimension after loading dated snapshots one after the other.

    Gives what :func:`initial_dimension` and repeated :func:`scd2_apply` give,
    in one shuffle by business key: a row starts a version when it is the key's
    first or differs from the key's row before, and ends where the next version
    starts. A key has at most one row per snapshot, which bounds the window.
    """
    feed = reduce(
        DataFrame.unionByName,
        [
            conform(snapshot, spec).withColumn("valid_from", date_column(as_date(day)))
            for day, snapshot in snapshots
        ],
    )
    by_key = Window.partitionBy(spec.key).orderBy("valid_from")
    before = {f"prev_{name}": F.lag(name).over(by_key) for name in spec.tracked}
    starts = F.col("nth") == 1
    differs = any_differs((F.col(name), F.col(f"prev_{name}")) for name in spec.tracked)
    next_start = F.lead("valid_from").over(by_key)
    # The window sees a repeated key beside its first row.
    again = F.coalesce(F.lag("valid_from").over(by_key) == F.col("valid_from"), F.lit(False))
    wrong = F.col("again") | F.col(spec.key).isNull()
    versions = (
        feed.withColumns({"nth": F.row_number().over(by_key), "again": again, **before})
        .where(starts | differs | wrong)
        .withColumn("wrong", wrong)
        .withColumn("valid_to", F.coalesce(F.date_sub(next_start, 1), F.lit(OPEN_END)))
        .select(*spec.attributes, "valid_from", "valid_to", "wrong")
    )
    written = materialize(versions, "versions")
    if not written.where("wrong").isEmpty():
        raise ValueError(f"business key {spec.key} is NULL or repeats within a snapshot")
    written = written.drop("wrong")
    return (
        assign_surrogate_keys(written, ["valid_from", spec.key], start, spec.sk)
        .withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END))
        .select(*spec.columns)
    )


def _numbered_inserts(
    classified: DataFrame, spec: ScdSpec, max_sk: int | Column, extra: Sequence[str] = ()
) -> DataFrame:
    """New and changed rows, numbered.

    Numbering samples its input before it shuffles it. The rows, as a rule few
    of the snapshot's, are written first, so that the join does not run twice.
    """
    inserts = classified.where(F.col("change").isin(NEW, CHANGED))
    written = materialize(inserts.select(*spec.attributes, *extra), "inserts")
    return assign_surrogate_keys(written, spec.key, max_sk, spec.sk)


def _opened(numbered: DataFrame, spec: ScdSpec, valid_from: str | dt.date | Column) -> DataFrame:
    return numbered.select(
        spec.sk,
        *spec.attributes,
        date_column(valid_from).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _require_business_keys(rows: DataFrame, keys: Sequence[str]) -> None:
    """Refuse rows whose key is NULL or repeated: they would break the history.

    Only the key columns are read, and counted before they are shuffled.
    """
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    unknown = reduce(or_, [F.col(key).isNull() for key in keys])
    most, unkeyed = per_key.agg(
        F.max("n"), F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0))
    ).head()
    if unkeyed or (most or 0) > 1:
        raise ValueError(
            f"business key {list(keys)} is NULL in {unkeyed} rows and occurs up to {most} times"
        )
