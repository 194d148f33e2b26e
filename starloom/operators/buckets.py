"""Dimensions stored by bucket of their key, of which a load rewrites what it changes.

A stored dimension is partitioned by current flag, bucket and load. A load writes
the whole current rows of the buckets it changes, and the versions it closes in
them; of a bucket's current rows those of its newest load count. Closed versions
are never read or written again. Nothing that is read is overwritten, so a load
that fails halfway leaves some buckets done, and repeating it does the others:
keys stay unique then, but may have gaps.

Beside the rows a digest of each bucket's current keys and tracked attributes is
kept. A bucket of a snapshot with the same digest has no change: its rows are not
read or joined.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.compare import row_hash
from starloom.functions.dates import as_date
from starloom.operators.scd2 import ScdSpec, conform, scd2_apply
from starloom.sources.scratch import materialize

BUCKET, LOAD, FLAG = "dim_bucket", "dim_load", "is_current"
DIGESTS = "bucket INT, load DATE, rows LONG, sum DECIMAL(38,0), mixed LONG, top_key LONG, buckets INT"


@dataclass(frozen=True)
class BucketStore:
    """Where a dimension is stored, its columns and types, and its number of buckets.

    The number is fixed by the first load; one task handles a bucket, so choose
    it for buckets of some 100 MB. Up to that many numbers reach the driver.
    """

    path: str
    spec: ScdSpec
    schema: T.StructType
    buckets: int

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def digests(self) -> str:
        return f"{self.path}/digests"


@dataclass(frozen=True)
class BucketLoad:
    """How many buckets the snapshot reached, a load read, and it wrote anew."""

    reached: int
    read: int
    written: int


def create_buckets(
    dim: DataFrame, path: str, spec: ScdSpec, buckets: int, load: str | dt.date
) -> BucketStore:
    """Store ``dim`` with its history as the first load.

    A first load that failed is repeated in a new path.
    """
    store = BucketStore(path, spec, dim.select(*spec.columns).schema, buckets)
    day = as_date(load)
    placed = dim.select(*spec.columns).withColumn(BUCKET, _bucket(store))
    _write(placed, store, day)
    spark = dim.sparkSession
    _note_digests(spark, store, _newest(spark, store))
    return store


def read_buckets(spark: SparkSession, store: BucketStore) -> DataFrame:
    """The dimension: closed versions, and the current rows of each bucket's newest load."""
    newest = _listed(spark, _newest(spark, store))
    stored = _stored(spark, store).join(F.broadcast(newest), BUCKET)
    counts = F.when(F.col(FLAG), F.col(LOAD) == F.col("newest")).otherwise(F.col(LOAD) <= F.col("newest"))
    return stored.where(counts).select(*store.spec.columns)


def load_buckets(
    spark: SparkSession, store: BucketStore, snapshot: DataFrame, as_of: str | dt.date
) -> BucketLoad:
    """Load ``snapshot`` into the stored dimension; what it then holds is what
    :func:`scd2_apply` gives.

    The snapshot is written to scratch once. It may also have the rows of some
    keys only; buckets it does not reach are left alone. A business key that is
    NULL or repeats raises, and so does a day that is not after the last load of
    a bucket it would change, except that a repeated load finds nothing to do.
    """
    spec, day = store.spec, as_date(as_of)
    conformed = replace(spec, rename={name: name for name in spec.attributes})
    feed = materialize(conform(snapshot, spec).withColumn(BUCKET, _bucket(store)), "snapshot")
    newest = _newest(spark, store)
    known = _known_digests(spark, store, newest)

    arrived = {row["bucket"]: row for row in _digest_of(feed, spec).collect()}
    differ = [b for b, row in arrived.items() if b not in known or _value(row) != _value(known[b])]
    if not differ:
        return BucketLoad(len(arrived), 0, 0)

    top = max((row["top_key"] for row in known.values()), default=0)
    before = _current(spark, store, {b: newest[b] for b in differ if b in newest})
    rows = feed.where(F.col(BUCKET).isin(differ))
    after = scd2_apply(before, rows, conformed, day, max_sk=top).withColumn(BUCKET, _bucket(store))
    added = after.where(F.col(spec.sk) > top).select(BUCKET).distinct()
    touched = [row[BUCKET] for row in added.collect()]
    if done := [b for b in touched if b in newest and newest[b] >= day]:
        raise ValueError(f"{len(done)} buckets to change have a load of {day} or later")
    if touched:
        _write(after.where(F.col(BUCKET).isin(touched)), store, day)
        _note_digests(spark, store, dict.fromkeys(touched, day))
    return BucketLoad(len(arrived), len(differ), len(touched))


def superseded(spark: SparkSession, store: BucketStore) -> DataFrame:
    """Partitions of current rows that a newer load of their bucket has replaced.

    They can be deleted once nobody reads the state before it.
    """
    held = _stored(spark, store).where(FLAG).select(BUCKET, LOAD).distinct()
    newest = _listed(spark, _newest(spark, store))
    return held.join(F.broadcast(newest), BUCKET).where(F.col(LOAD) < F.col("newest")).drop("newest")


def _bucket(store: BucketStore) -> Column:
    return F.pmod(F.xxhash64(store.spec.key), F.lit(store.buckets)).cast("int")


def _write(placed: DataFrame, store: BucketStore, day: dt.date) -> None:
    """Rows of whole buckets, one task a bucket; a load replaces only its own partitions."""
    (
        placed.withColumn(LOAD, F.lit(day))
        .repartition(BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(FLAG, BUCKET, LOAD)
        .parquet(store.rows)
    )


def _schema(store: BucketStore) -> T.StructType:
    fields = [field for field in store.schema.fields if field.name != FLAG]
    parts = [(FLAG, T.BooleanType()), (BUCKET, T.IntegerType()), (LOAD, T.DateType())]
    return T.StructType([*fields, *[T.StructField(*part) for part in parts]])


def _stored(spark: SparkSession, store: BucketStore) -> DataFrame:
    return spark.read.schema(_schema(store)).parquet(store.rows)


def _newest(spark: SparkSession, store: BucketStore) -> dict[int, dt.date]:
    """The last load of each bucket; only partition values are read."""
    per_bucket = _stored(spark, store).where(FLAG).groupBy(BUCKET).agg(F.max(LOAD).alias("newest"))
    return {row[BUCKET]: row["newest"] for row in per_bucket.collect()}


def _listed(spark: SparkSession, newest: dict[int, dt.date]) -> DataFrame:
    return spark.createDataFrame(list(newest.items()), f"{BUCKET} INT, newest DATE")


def _current(spark: SparkSession, store: BucketStore, loads: dict[int, dt.date]) -> DataFrame:
    """Current rows of some buckets, read from just their directories."""
    if not loads:
        return spark.createDataFrame([], _schema(store))
    paths = [f"{store.rows}/{FLAG}=true/{BUCKET}={b}/{LOAD}={day}" for b, day in sorted(loads.items())]
    return spark.read.schema(_schema(store)).option("basePath", store.rows).parquet(*paths)


def _digest_of(rows: DataFrame, spec: ScdSpec) -> DataFrame:
    """Two sums over hashes of key and tracked attributes, 128 bits in all, by bucket.

    A hash passes over NULL, so which values are NULL is hashed as well.
    """
    compared = rows.select(spec.key, *spec.tracked)
    gaps = F.concat(*[F.col(name).isNull().cast("string") for name in compared.columns])
    return rows.groupBy(F.col(BUCKET).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash(compared, gaps).cast("decimal(28,0)")).alias("sum"),
        F.bit_xor(row_hash(compared, F.lit(1), gaps)).alias("mixed"),
    )


def _value(row: Row) -> tuple:
    return row["rows"], row["sum"], row["mixed"]


def _note_digests(spark: SparkSession, store: BucketStore, loads: dict[int, dt.date]) -> None:
    """Add the digests of written buckets; one that is noted twice is noted alike."""
    current = _current(spark, store, loads)
    tops = current.groupBy(F.col(BUCKET).alias("bucket")).agg(
        F.max(LOAD).alias("load"), F.max(store.spec.sk).cast("long").alias("top_key")
    )
    noted = _digest_of(current, store.spec).join(tops, "bucket").withColumn("buckets", F.lit(store.buckets))
    noted = noted.select(*T.StructType.fromDDL(DIGESTS).names).coalesce(1)
    noted.write.mode("append").parquet(store.digests)


def _known_digests(
    spark: SparkSession, store: BucketStore, newest: dict[int, dt.date]
) -> dict[int, Row]:
    """Digests of each bucket's newest load.

    A load that ended between its rows and its digests has some missing; they are
    made up for here.
    """
    known = _read_digests(spark, store, newest)
    if missing := {b: day for b, day in newest.items() if b not in known}:
        _note_digests(spark, store, missing)
        known = _read_digests(spark, store, newest)
    if wrong := {row["buckets"] for row in known.values()} - {store.buckets}:
        raise ValueError(f"the dimension is stored in {wrong} buckets, not {store.buckets}")
    return known


def _read_digests(
    spark: SparkSession, store: BucketStore, newest: dict[int, dt.date]
) -> dict[int, Row]:
    listed = _listed(spark, newest).select(F.col(BUCKET).alias("bucket"), F.col("newest").alias("load"))
    noted = spark.read.schema(DIGESTS).parquet(store.digests).join(F.broadcast(listed), ["bucket", "load"])
    return {row["bucket"]: row for row in noted.dropDuplicates(["bucket"]).collect()}
