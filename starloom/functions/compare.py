"""Null-safe comparison of attribute lists, and hashes of whole rows."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when at least one pair differs; NULL equals only NULL."""
    return reduce(or_, [~left.eqNullSafe(right) for left, right in pairs], F.lit(False))


def row_hash(df: DataFrame, *first: Column) -> Column:
    """64-bit hash of a row's columns, taken in the order of their names, after ``first``."""
    fields = sorted(df.schema.fields, key=lambda field: field.name)
    return F.xxhash64(*first, *[_hashable(F.col(field.name), field.dataType) for field in fields])


def _hashable(value: Column, kind: T.DataType) -> Column:
    # Spark hashes no maps and variants; their text stands in for them.
    return F.to_json(F.struct(value)) if _holds_map(kind) else value


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))
