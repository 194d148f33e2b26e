"""Surrogate keys: dense numbers in key order, without a one-task window."""

from __future__ import annotations

from itertools import accumulate
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.compare import row_hash
from starloom.sources.scratch import materialize

# monotonically_increasing_id puts the partition number above this many bits
# and counts the partition's rows below them.
_ROW_BITS = 33


def max_key(table: DataFrame, sk: str) -> Column:
    """Highest surrogate key in ``table``, 0 when it is empty, as a subquery."""
    return table.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()


def assign_surrogate_keys(
    df: DataFrame,
    order_by: str | Sequence[str],
    start: int | Column = 0,
    sk: str = "surrogate_key",
) -> DataFrame:
    """Number the rows of ``df`` from ``start + 1`` up, in ``order_by`` order.

    Rows are range-partitioned and sorted, each partition numbers its own rows,
    and the partitions' row counts give every partition its offset: one shuffle
    and no task that sees more than its range. Ties are broken by the row's
    hash, then by where the row came from, so many rows with one key, or many
    copies of one row, still divide over partitions; the numbers do not depend
    on the partitioning unless rows are exact copies.

    The ranges come from a sample, so the numbered rows are written to the
    scratch folder before they are counted; this runs when called. Only one
    count per partition reaches the driver.
    """
    spark = df.sparkSession
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ties = ["__tie", "__origin"]
    ranged = (
        df.withColumn("__tie", row_hash(df))
        .withColumn("__origin", F.spark_partition_id())
        .repartitionByRange(*order, *ties)
        .sortWithinPartitions(*order, *ties)
    )
    placed = materialize(
        ranged.select(*df.columns, F.monotonically_increasing_id().alias("__place")), "numbered"
    )
    part = F.shiftright("__place", _ROW_BITS)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = [0, *accumulate(row["count"] for row in counts)]
    offsets = spark.createDataFrame(
        [(row["part"], rows) for row, rows in zip(counts, before)],
        "__part LONG, __before LONG",
    )
    first = start if isinstance(start, Column) else F.lit(start)
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .select(
            (first + F.col("__before") + row + 1).cast("long").alias(sk),
            *df.columns,
        )
    )
