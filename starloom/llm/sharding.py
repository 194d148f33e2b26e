"""Shuffling records into shards by a two-pass external shuffle.

The first pass scatters records uniformly into buckets that fit in memory, by
a seeded hash of their contents. The second shuffles each bucket by
Fisher-Yates and writes it out. The buckets one after another are a uniformly
shuffled sequence; shards are equal runs of it, so their row counts differ by
one at most, and a bucket is written to one or two of them.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.shared import shared_folder

SHARDS = 40
SEED = 7
# Bytes of text in a bucket, which one task holds in memory.
BUCKET_BYTES = 16 * 1024 * 1024


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of a record's text (null: none), plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def _bucket(columns: list[Column], seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets)).cast("int")


def permutation(n: int, *seed: int) -> np.ndarray:
    """A uniform permutation of ``n`` by Fisher-Yates, decided by the seed."""
    order = np.arange(n)
    swaps = np.random.default_rng(list(seed)).integers(0, np.arange(n, 0, -1)) if n else []
    for i, step in enumerate(swaps):
        j = i + int(step)
        order[i], order[j] = order[j], order[i]
    return order


def shard_records(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """``docs`` shuffled over ``shards`` shards, with their ``shard`` and ``slot``.

    The rows are written as Parquet to ``path`` (by default a new shared
    folder), one directory a shard, and read back. Every row of ``docs`` is
    there once, repeats and nulls included; a shard's slots run from 0 without
    gaps. Where things go depends on the rows and the seed alone: within a
    bucket rows are ordered by a hash of all columns before they are shuffled.
    Columns of ``docs`` named ``shard`` or ``slot`` are replaced. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.drop("shard", "slot")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    keys = [c for c in ("doc_id", "text") if c in rows.columns]
    hashed = [F.col(c) for c in keys] or columns
    size = record_bytes(F.col("text")) if "text" in rows.columns else F.lit(1024).cast("long")
    # Fine buckets are counted in one pass, and whole runs of them make a bucket.
    fine = 1 << 16
    counts = rows.groupBy(_bucket(hashed, seed, fine).alias("fine")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")
    ).collect()
    total = sum(r["rows"] for r in counts)
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(fine, max(at_least, -(-sum(r["bytes"] for r in counts) // bucket_bytes)))
    per = [0] * buckets
    for r in counts:
        per[r["fine"] * buckets // fine] += r["rows"]
    before = [0, *accumulate(per)]
    edges = [s * total // shards for s in range(shards + 1)]
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    )

    def shuffled(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        order = np.argsort(table["__order"].to_numpy(), kind="stable")
        order = order[permutation(len(order), seed, number)]
        place = before[number] + np.arange(len(order))
        shard = np.searchsorted(edges, place, "right") - 1
        out = table.drop_columns(["__bucket", "__order"]).take(order)
        out = out.append_column("shard", pa.array(shard, pa.int32()))
        return out.append_column("slot", pa.array(place - np.array(edges)[shard], pa.int64()))

    scattered = rows.withColumns(
        {
            "__bucket": (_bucket(hashed, seed, fine).cast("long") * buckets / fine).cast("int"),
            "__order": F.xxhash64(F.lit(seed + 1), *columns),
        }
    )
    path = path or shared_folder(spark, "shards")
    mixed = scattered.groupBy("__bucket").applyInArrow(shuffled, schema)
    mixed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def crc32_of(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes, of which null has none."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


