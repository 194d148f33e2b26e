"""Facts whose dimension rows arrive later than they do.

A cycle looks up the keys of new facts. Those missing a required key are not
loaded but suspended, with their natural keys; the next cycle looks them up
again together with its own new facts and releases the ones now complete.
Every fact of a cycle is either ready or suspended.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_column
from starloom.operators.star import DimensionKey, load_fact

PROCESSED = "processed_flag"
FIRST_SEEN = "first_seen"


def is_processed() -> Column:
    """Whether a fact was released; a fact without a flag was not."""
    return F.coalesce(F.col(PROCESSED), F.lit(False))


def required_keys(keys: Sequence[DimensionKey]) -> list[str]:
    """Surrogate keys without which a fact is suspended."""
    return [key.sk for key in keys if key.required]


def flag_processed(fact: DataFrame, sk_cols: Sequence[str]) -> DataFrame:
    """Mark facts that have all of ``sk_cols`` as processed."""
    complete = reduce(and_, [F.col(sk).isNotNull() for sk in sk_cols])
    return fact.withColumn(PROCESSED, complete)


def split_suspended(
    fact: DataFrame,
    sk_cols: Sequence[str],
    first_seen: str | dt.date | Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Facts that can be loaded, and suspended ones with ``processed_flag`` false.

    With ``first_seen`` suspended facts carry that date, by which a caller can
    find the ones waiting too long.
    """
    flagged = flag_processed(fact, sk_cols)
    suspended = flagged.where(~is_processed())
    if first_seen is not None:
        suspended = suspended.withColumn(FIRST_SEEN, date_column(first_seen))
    return flagged.where(PROCESSED).drop(PROCESSED), suspended


def retry_suspended(suspended: DataFrame, keys: Sequence[DimensionKey]) -> DataFrame:
    """Look waiting facts up again and set their ``processed_flag`` anew.

    Only the required keys are looked up; others, such as the date, keep what
    the first cycle found. Facts released before are left out.
    """
    required = [key for key in keys if key.required]
    names = [key.sk for key in required]
    waiting = suspended.where(~is_processed()).drop(*names, PROCESSED)
    found = flag_processed(load_fact(waiting, required, mode="suspend"), names)
    return found.select(*suspended.columns)


def next_cycle(
    new_raw: DataFrame,
    suspended: DataFrame | None,
    keys: Sequence[DimensionKey],
    first_seen: str | dt.date | Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New facts and released ones that are complete; and what still waits.

    The second frame replaces the suspense table: it holds the waiting facts
    that stay incomplete and the incomplete new ones, so nothing is released
    twice.
    """
    return split_cycle(resolve_cycle(new_raw, suspended, keys, first_seen))


def resolve_cycle(
    new_raw: DataFrame,
    suspended: DataFrame | None,
    keys: Sequence[DimensionKey],
    first_seen: str | dt.date | Column | None = None,
) -> DataFrame:
    """A cycle's new and waiting facts, looked up and flagged, exact copies once.

    Both share one pass through the required lookups. Copies are dropped within
    each task before the rest is shuffled. A cycle that needs ready and
    suspended facts should write this frame once, see :func:`land_cycle`.
    """
    required = [key for key in keys if key.required]
    optional = [key for key in keys if not key.required]
    names = [key.sk for key in required]
    candidates = load_fact(new_raw, optional, mode="suspend")
    if first_seen is not None:
        candidates = candidates.withColumn(FIRST_SEEN, date_column(first_seen))
    if suspended is not None:
        waiting = suspended.where(~is_processed()).drop(*names, PROCESSED)
        # Facts of a side that keeps no date of first sight have none.
        one_dated = (FIRST_SEEN in candidates.columns) != (FIRST_SEEN in waiting.columns)
        candidates = candidates.unionByName(waiting, allowMissingColumns=one_dated)
    found = flag_processed(load_fact(candidates, required, mode="suspend"), names)
    if suspended is not None:
        dated = [FIRST_SEEN] if FIRST_SEEN in found.columns else []
        found = found.select(*dict.fromkeys([*suspended.columns, *dated]))
    if FIRST_SEEN not in found.columns:
        return found.dropDuplicates()
    same = [name for name in found.columns if name != FIRST_SEEN]
    return found.groupBy(*same).agg(F.min(FIRST_SEEN).alias(FIRST_SEEN)).select(*found.columns)


def split_cycle(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ready facts of a resolved cycle, and those that stay suspended."""
    ready = resolved.where(PROCESSED).drop(PROCESSED, FIRST_SEEN)
    return ready, resolved.where(~is_processed())


def land_cycle(
    resolved: DataFrame, path: str, mode: str = "errorifexists"
) -> tuple[DataFrame, DataFrame]:
    """Write a resolved cycle once, then split it by reading its partitions.

    Overwriting replaces the whole cycle, whatever the session's setting for
    partitions: a part left from before would hold released facts again.
    """
    writer = resolved.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(PROCESSED).parquet(path)
    return split_cycle(stored_cycle(resolved.sparkSession, path, resolved.schema))


def stored_cycle(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A landed cycle as it was resolved."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
