"""Sums and means that keep every value as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sum_of(df: DataFrame, value: Column) -> Column:
    """Sum of ``value`` over its non-null rows.

    Decimals are added exactly, in the widest decimal of their scale, so the
    result does not depend on the partitioning; money belongs in decimals.
    Doubles are added as doubles: nothing is rounded, NaN and infinity count,
    and the last bits may differ with the order in which partitions arrive.
    """
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.DecimalType):
        value = value.cast(T.DecimalType(38, kind.scale))
    return F.sum(value)


def mean_of(df: DataFrame, value: Column) -> Column:
    """Mean of ``value`` over its non-null rows as a double, from :func:`sum_of`."""
    return F.try_divide(sum_of(df, value).cast("double"), F.count(value).cast("double"))
