"""Lookups of the version that was valid on a row's own day.

An interval join has no key that Spark could shuffle or broadcast by. Here days
are cut into bins: each version is listed in the bins it reaches into, and a row
looks up the one list of its key and bin. That is an ordinary lookup with a
unique key, so sizes are measured and frequent keys spread as for any other, and
the version is picked from a list that holds at most one a day of the bin.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.dates import OPEN_END
from starloom.operators.lookup import Lookup, resolve
from starloom.sources.scratch import materialize

# Wider bins list a long-lived version less often, but a key's versions together.
BIN_DAYS = 366


def resolve_valid(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    *,
    version_key: str | None = None,
    how: str = "left",
    bin_days: int = BIN_DAYS,
    keys_from: DataFrame | None = None,
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``rows`` with columns of the version of ``key`` that was valid on ``day``.

    ``versions`` has the interval ``valid_from``..``valid_to``, both days
    included, as :func:`scd2_replay` gives it; a NULL ``valid_to`` is open. A row
    whose key or day is NULL, or that lies in no interval of its key, gets NULLs,
    or is left out if ``how`` is ``inner``. Rows never multiply: two versions of a
    key that share a day raise. Versions without a key or a first day, or that
    end before they start, are never valid.

    ``versions`` are read once, and written by key and bin for the days that occur
    in ``rows``. ``keys_from`` is a frame with ``key`` and ``day`` to take those days
    and the frequent keys from, where ``rows`` is too dear to run twice.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup is left or inner, not {how}")
    clash = set(rows.columns) & set(take)
    if clash:
        raise ValueError(f"looked-up columns exist already: {sorted(clash)}")
    if bin_days < 1:
        raise ValueError("a bin has at least one day")
    version_key = version_key or key
    seen = (rows if keys_from is None else keys_from).select(key, F.col(day).cast("date").alias("__day"))
    first, last = seen.where(F.col(key).isNotNull()).agg(F.min("__day"), F.max("__day")).head()
    # Without a day there is nothing to find; the empty range lists no version.
    first, last = (first, last) if first else (OPEN_END, OPEN_END)
    listed = materialize(_listed(versions, version_key, take, bin_days, first, last), "valid")
    with_bin = rows.withColumn("__bin", _bin(F.col(day).cast("date"), bin_days))
    found = resolve(
        with_bin,
        [
            Lookup(
                listed,
                {key: version_key, "__bin": "__bin"},
                ["__versions"],
                keys_from=seen.select(key, _bin(F.col("__day"), bin_days).alias("__bin")),
            )
        ],
        broadcast_bytes,
        hot_rows,
    )
    on = F.col(day).cast("date")
    valid = F.filter("__versions", lambda v: (v["__from"] <= on) & (v["__to"] >= on))
    found = found.withColumn("__valid", F.get(valid, F.lit(0)))
    if how == "inner":
        found = found.where(F.col("__valid").isNotNull())
    return found.select(*rows.columns, *[F.col("__valid")["__taken"][name].alias(name) for name in take])


def _bin(day: Column, bin_days: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(bin_days))


def _listed(
    versions: DataFrame, key: str, take: Sequence[str], bin_days: int, first: object, last: object
) -> DataFrame:
    """Versions by key and bin, of the bins from ``first`` to ``last``.

    One shuffle by key serves the check for overlaps and the lists.
    """
    by_key = Window.partitionBy("__key").orderBy("__from")
    end = F.coalesce(F.col("valid_to").cast("date"), F.lit(OPEN_END))
    spans = versions.select(
        F.col(key).alias("__key"),
        F.col("valid_from").cast("date").alias("__from"),
        end.alias("__to"),
        F.struct(*[F.col(name) for name in take]).alias("__taken"),
    ).where("__key is not null and __from <= __to")
    overlap = F.raise_error(F.concat(F.lit("versions of one key overlap on "), F.col("__to"))).cast("date")
    checked = spans.withColumn("__next", F.lead("__from").over(by_key)).withColumn(
        "__to", F.when(F.col("__next") <= F.col("__to"), overlap).otherwise(F.col("__to"))
    )
    reached = checked.where((F.col("__to") >= F.lit(first)) & (F.col("__from") <= F.lit(last)))
    bins = F.sequence(
        _bin(F.greatest("__from", F.lit(first)), bin_days), _bin(F.least("__to", F.lit(last)), bin_days)
    )
    return (
        reached.select("__key", "__from", "__to", "__taken", F.explode(bins).alias("__bin"))
        .groupBy("__key", "__bin")
        .agg(F.collect_list(F.struct("__from", "__to", "__taken")).alias("__versions"))
        .withColumnRenamed("__key", key)
    )
