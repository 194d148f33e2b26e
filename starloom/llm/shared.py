"""Intermediate tables and joins that the operators of this package share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table may be broadcast up to this size, measured before it is.
BROADCAST_BYTES = 64 * 1024 * 1024

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def pieces_of(data: bytes, size: int = 1 << 23) -> Iterator[bytes]:
    """``data`` in order, cut at white space into pieces of ``size`` or a little more."""
    at = 0
    while len(data) - at > size and (found := _SPACE.search(data, at + size)):
        yield data[at : found.start()]
        at = found.end()
    yield data[at:] if at else data


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which every executor reaches.

    Without that setting a temporary folder serves in local mode; a cluster raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    What is read back does not depend on the executors that made it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Null-safe equality of ``columns``: a null id is a value like any other."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def keep_only(
    df: DataFrame, ids: DataFrame, column: str, how: str = "left_semi", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``df`` whose ``column`` is (or with ``left_anti`` is not) in ``ids``.

    ``ids`` is broadcast only if it is small when counted; else both sides are
    shuffled. Null counts as an id.
    """
    ids = ids.select(F.col(column).alias("__id")).distinct()
    if ids.count() * 64 <= limit:
        ids = F.broadcast(ids)
    return df.join(ids, df[column].eqNullSafe(ids["__id"]), how)


def batches_of(columns: Sequence[str]):
    """The columns of an Arrow batch as Python lists; for ``mapInArrow`` functions."""

    def lists(batch):
        return [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]

    return lists
