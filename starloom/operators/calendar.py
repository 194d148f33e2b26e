"""Date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import as_date, calendar_columns


def date_dimension(
    spark: SparkSession,
    start: str | dt.date = "2025-01-01",
    end: str | dt.date = "2026-12-31",
) -> DataFrame:
    """One row per day from ``start`` to ``end``, numbered from 1.

    ``calendar_date`` is the typed join key; ``full_date`` is its ISO text.
    """
    first = as_date(start)
    days = days_between(start, end)
    numbered = spark.range(0, days, 1, numPartitions=1).select(
        (F.col("id") + 1).cast("int").alias("date_sk"),
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("calendar_date"),
    )
    return numbered.withColumns(calendar_columns(F.col("calendar_date")))


def days_between(start: str | dt.date, end: str | dt.date) -> int:
    """Number of days from ``start`` to ``end``, both counted."""
    return max(0, (as_date(end) - as_date(start)).days + 1)


def date_dimension_over(df: DataFrame, column: str) -> DataFrame:
    """Date dimension spanning the dates that occur in ``df``.

    The range is one aggregate over the column; its days are exploded from it.
    """
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.where(F.col("first").isNotNull()).select(
        F.posexplode(F.sequence("first", "last")).alias("position", "calendar_date")
    )
    return days.select(
        (F.col("position") + 1).alias("date_sk"), "calendar_date"
    ).withColumns(calendar_columns(F.col("calendar_date")))
