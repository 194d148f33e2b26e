"""Distinct counts kept across loads, exactly.

How many orders a category has cannot be added up over months, as an order may
have lines in two. What can be merged is the set: the ids of a group are bits of
bitmaps by bucket of 32,768 ids, built before the shuffle and merged by ``or``.
A load adds its own bitmaps and earlier rows are not read again. A bitmap has 4 KB
however many bits it holds, so ids should lie closely, as surrogate keys do.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, BITMAP = "id_bucket", "id_bitmap"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def distinct_state(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Bitmaps of the values of an integer column, a row per group and bucket.

    NULL values are in no bitmap, but their group is kept. NULL is a group of its own.
    """
    if not isinstance(rows.schema[value].dataType, _INTEGERS):
        raise TypeError(f"{value} is no integer; number it first")
    number = F.col(value).cast("long")
    return rows.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP)
    )


def save_state(state: DataFrame, path: str, load: str) -> None:
    """Write the state by its column ``load``; loads it holds are replaced, others stay.

    So a load that is repeated after a failure counts once.
    """
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(load).parquet(path)


def read_state(spark: SparkSession, path: str, state: DataFrame) -> DataFrame:
    """What was saved, with the columns and types of ``state``."""
    return spark.read.schema(state.schema).parquet(path).select(*state.columns)


def merge_states(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """One bitmap a group and bucket, over all loads, or with fewer columns in ``by``."""
    return state.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_counts(state: DataFrame, by: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Distinct values of each group; buckets are merged, then counted, then added."""
    merged = merge_states(state, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))
