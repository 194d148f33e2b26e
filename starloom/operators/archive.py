"""Quarterly archives of date-partitioned tables, with a retention manifest.

An archive is a directory written once. A working copy takes loads: each is a
partition of its own, replaced as a whole when the load is repeated. Its manifest row holds the quarter, the
row count and a checksum read back from storage, and when it may be dropped.
Plain files have no zero-copy clone, so the rows of a quarter are written once,
straight into the archive, rather than to a working copy that is then cloned; a
working copy can still be asked for.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.compare import row_hash
from starloom.functions.dates import as_date, previous_quarter_dates
from starloom.sources.files import partition_column

RETENTION_DAYS = 365

# Name part and write mode: a working copy may be replaced, an archive never.
KINDS = {"copy": "overwrite", "snapshot": "errorifexists"}

# Partition column of a working copy, and the load that a copy starts with.
LOAD, FIRST_LOAD = "archive_load", "first"
_LOAD_NAME = re.compile(r"[A-Za-z0-9_.-]+")

_DONE = "archive_name STRING, table_name STRING, kind STRING, quarter_start DATE, quarter_end DATE, path STRING, fields STRING"


@dataclass(frozen=True)
class Archive:
    """Where a quarter of a table was written."""

    table: str
    kind: str
    start: dt.date
    end: dt.date
    path: str
    schema: T.StructType | None = None

    @property
    def name(self) -> str:
        return archive_name(self.table, self.kind, self.start, self.end)


def archive_name(table: str, kind: str, start: dt.date, end: dt.date) -> str:
    """``<table>_<kind>_<first day>_<last day>``."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {sorted(KINDS)}, not {kind}")
    return f"{table}_{kind}_{start:%Y%m%d}_{end:%Y%m%d}"


def rows_between(df: DataFrame, date_column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows from ``start`` to ``end``, both days included.

    The column is compared as it is, with a half-open range: a cast around it
    would keep the filter from pruning partitions and row groups.
    """
    kind = df.schema[date_column].dataType
    first, after = F.lit(start).cast(kind), F.lit(end + dt.timedelta(days=1)).cast(kind)
    return df.where((F.col(date_column) >= first) & (F.col(date_column) < after))


def archive_quarter(
    df: DataFrame,
    table: str,
    date_column: str,
    as_of: str | dt.date,
    out: str,
    kind: str = "snapshot",
    partition_by: str | None = None,
    load: str | None = None,
) -> Archive:
    """Write the last full quarter before ``as_of`` under ``out``.

    A snapshot that exists is an error and a working copy is replaced as a
    whole. With ``load`` the rows are added to a working copy under that name: a
    load repeated after a failure replaces its own rows and no others.

    With ``partition_by`` rows are brought together by that column first;
    Spark divides a value too large for one file over several tasks.
    """
    if load is not None and (kind != "copy" or not _LOAD_NAME.fullmatch(load)):
        raise ValueError("loads are added to working copies, by a name of letters, digits, _ . and -")
    return _write_quarter(df, table, date_column, as_of, out, kind, partition_by, load, KINDS[kind])


def _write_quarter(
    df: DataFrame, table: str, date_column: str, as_of: str | dt.date, out: str, kind: str,
    partition_by: str | None, load: str | None, mode: str,
) -> Archive:
    start, end = previous_quarter_dates(as_of)
    rows = rows_between(df, date_column, start, end)
    path = f"{out}/{archive_name(table, kind, start, end)}"
    archive = Archive(table, kind, start, end, path, df.schema)
    if partition_by is not None:
        rows = rows.hint("rebalance", F.col(partition_by))
    by = [partition_by] if partition_by else []
    if load is not None:
        # The load's directory is all that is written, so loads may run side by side.
        path = f"{path}/{LOAD}={load}"
    elif kind == "copy":
        rows, by = rows.withColumn(LOAD, F.lit(FIRST_LOAD)), [LOAD, *by]
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """An archive's rows with the types and column order they were written from.

    The schema is not inferred: names of partition directories would turn text
    such as ``001`` into a number, and an empty quarter has no file to look at.
    """
    if archive.schema is None:
        return spark.read.parquet(archive.path).drop(LOAD)
    stored = spark.read.schema(archive.schema).parquet(archive.path)
    return stored.select(*archive.schema.names)


def archive_tables(
    spark: SparkSession,
    tables: Sequence[str],
    as_of: str | dt.date,
    out: str,
    date_columns: Mapping[str, str] | None = None,
    kind: str = "snapshot",
) -> list[Archive]:
    """Archive each catalog table of a list by its partition column.

    ``date_columns`` names the column of tables that are not partitioned.
    """
    given = date_columns or {}
    return [
        archive_quarter(
            spark.table(table),
            table,
            given.get(table) or partition_column(spark, table),
            as_of,
            out,
            kind,
        )
        for table in tables
    ]


@dataclass(frozen=True)
class Outcome:
    """What became of one entry of a list: an archive, made now or before, or an error."""

    label: str
    archive: Archive | None = None
    error: str | None = None
    made_before: bool = False


def archive_list(
    spark: SparkSession,
    tables: Sequence[str],
    as_of: str | dt.date,
    out: str,
    date_columns: Mapping[str, str] | None = None,
    kind: str = "snapshot",
    at_once: int = 4,
) -> list[Outcome]:
    """Archive each catalog table of a list, several at once, whatever becomes of the others.

    A table that is done has a record under ``_done``, written last. Run again,
    the list takes up where it stopped: recorded archives are left alone, and
    what a failed run has left of the others is replaced.
    """
    given = date_columns or {}
    start, end = previous_quarter_dates(as_of)

    def job(table: str) -> Callable[[], Archive]:
        def run() -> Archive:
            column = given.get(table) or partition_column(spark, table)
            return _write_quarter(spark.table(table), table, column, as_of, out, kind, None, None, "overwrite")

        return run

    named = [(table, archive_name(table, kind, start, end), job(table)) for table in tables]
    return _run_recorded(spark, named, out, at_once)


def archive_quarters(
    spark: SparkSession, df: DataFrame, table: str, date_column: str, days: Sequence[dt.date], out: str,
    kind: str = "snapshot", at_once: int = 4,
) -> list[Outcome]:
    """Archive the quarters before each of ``days``, several at once, with records as of a list."""

    def job(day: dt.date) -> Callable[[], Archive]:
        return lambda: _write_quarter(df, table, date_column, day, out, kind, None, None, "overwrite")

    named = [
        (f"{table} {day}", archive_name(table, kind, *previous_quarter_dates(day)), job(day)) for day in days
    ]
    return _run_recorded(spark, named, out, at_once)


def _run_recorded(
    spark: SparkSession, jobs: Sequence[tuple[str, str, Callable[[], Archive]]], out: str, at_once: int
) -> list[Outcome]:
    done = {archive.name: archive for archive in done_archives(spark, out)}

    def run(label: str, name: str, job: Callable[[], Archive]) -> Outcome:
        if name in done:
            return Outcome(label, done[name], made_before=True)
        try:
            archive = job()
            _record(spark, archive, out)
        except Exception as failed:  # One table's failure is its outcome, not the list's.
            return Outcome(label, error=f"{type(failed).__name__}: {failed}")
        return Outcome(label, archive)

    # Threads share the session; with spark.scheduler.mode=FAIR their jobs share the executors too.
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda entry: inheritable_thread_target(spark)(run)(*entry), jobs))


def _record(spark: SparkSession, archive: Archive, out: str) -> None:
    fields = None if archive.schema is None else archive.schema.json()
    row = (archive.name, archive.table, archive.kind, archive.start, archive.end, archive.path, fields)
    spark.createDataFrame([row], _DONE).coalesce(1).write.mode("overwrite").parquet(f"{out}/_done/{archive.name}")


def done_archives(spark: SparkSession, out: str) -> list[Archive]:
    """The archives under ``out`` that were recorded as complete: one row each."""
    try:
        rows = spark.read.schema(_DONE).option("recursiveFileLookup", True).parquet(f"{out}/_done").collect()
    except AnalysisException:
        return []
    return [
        Archive(
            r.table_name, r.kind, r.quarter_start, r.quarter_end, r.path,
            None if r.fields is None else T.StructType.fromJson(json.loads(r.fields)),
        )
        for r in sorted(rows, key=lambda r: r.archive_name)
    ]


def archive_manifest(
    spark: SparkSession,
    archives: Sequence[Archive],
    created_at: str | dt.date | None = None,
    retention_days: int = RETENTION_DAYS,
) -> DataFrame:
    """One row per archive, with count and checksum as read back from storage.

    Retention counts from ``created_at``, or from the last day of each archive's quarter.
    """
    rows = []
    for archive in archives:
        expires = as_date(created_at or archive.end) + dt.timedelta(days=retention_days)
        stored = read_archive(spark, archive)
        rows.append(
            stored.agg(F.count(F.lit(1)).alias("row_count"), checksum(stored).alias("checksum"))
            .select(
                F.lit(archive.table).alias("table_name"),
                F.lit(archive.name).alias("archive_name"),
                F.lit(archive.path).alias("path"),
                F.lit(archive.start).alias("quarter_start"),
                F.lit(archive.end).alias("quarter_end"),
                "row_count",
                "checksum",
                F.lit(expires).cast("timestamp_ntz").alias("expires_at"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def store_manifest(manifest: DataFrame, log: str, state: str = "kept") -> int:
    """Add rows to the manifest stored under ``log`` as its next numbered entry.

    An entry is never changed: one whose number is taken is an error, so that of
    two runs at once only one succeeds. ``state`` is ``kept`` or ``dropped``.
    """
    if state not in ("kept", "dropped"):
        raise ValueError(f"a manifest row is kept or dropped, not {state}")
    last = _entries(manifest.sparkSession, log).agg(F.max("entry")).head()[0]
    number = 0 if last is None else last + 1
    rows = manifest.select(*[F.col(f.name).cast(f.dataType) for f in _MANIFEST.fields[:-2]])
    rows = rows.withColumns({"state": F.lit(state), "entry": F.lit(number).cast("long")})
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{log}/{number}")
    return number


_MANIFEST = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("archive_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("quarter_start", T.DateType()),
        T.StructField("quarter_end", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("expires_at", T.TimestampNTZType()),
        T.StructField("state", T.StringType()),
        T.StructField("entry", T.LongType()),
    ]
)


def _entries(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(log)
    except AnalysisException:
        return spark.createDataFrame([], _MANIFEST)


def live_manifest(spark: SparkSession, log: str) -> DataFrame:
    """The last stored row of every archive that was not dropped since."""
    last = _entries(spark, log).groupBy("archive_name").agg(
        F.max_by(F.struct(*_MANIFEST.names), "entry").alias("row")
    )
    return last.select("row.*").where("state = 'kept'").drop("state", "entry")


def sweep(spark: SparkSession, out: str, log: str, now: str | dt.date | dt.datetime) -> DataFrame:
    """``archive_name, fate, row_count`` of every directory under ``out`` and every live row.

    ``kept``; ``expired`` at ``now``; ``copied`` for working copies whose quarter
    is archived; ``unnamed`` for directories that no live row names, as failed
    runs and dropped archives leave them; ``missing`` for rows without their
    directory. All but the first and last may be deleted, which is the caller's,
    as is noting it with :func:`store_manifest`. Files are listed, not read.
    """
    live = live_manifest(spark, log)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out).select("path")
    name = F.regexp_extract("path", "/([^/]+_(?:" + "|".join(KINDS) + ")_[0-9]{8}_[0-9]{8})/", 1)
    found = files.select(name.alias("archive_name")).where("archive_name <> ''").distinct()
    expired = expired_archives(live, now).select("archive_name", F.lit(True).alias("expired"))
    copy_of = F.regexp_replace("archive_name", "_copy_([0-9]{8}_[0-9]{8})$", "_snapshot_$1")
    kept = live.join(expired, "archive_name", "left").select(
        "archive_name", copy_of.alias("snapshot"), "row_count", "expired"
    )
    archived = live.select(F.col("archive_name").alias("snapshot"), F.lit(True).alias("archived"))
    kept = kept.join(archived, "snapshot", "left")
    on_disk = found.withColumn("there", F.lit(True))
    both = kept.withColumn("live", F.lit(True)).join(on_disk, "archive_name", "full")
    is_copy = F.col("snapshot") != F.col("archive_name")
    fate = (
        F.when(F.col("live").isNull(), "unnamed")
        .when(F.col("there").isNull(), "missing")
        .when(is_copy & F.col("archived"), "copied")
        .when(F.col("expired"), "expired")
        .otherwise("kept")
    )
    return both.select("archive_name", fate.alias("fate"), "row_count")


def checksum(df: DataFrame) -> Column:
    """Sum of row hashes: equal for equal rows in any order and partitioning."""
    total = F.sum(row_hash(df).cast("decimal(20,0)"))
    return F.coalesce(total, F.lit(0)).cast("decimal(38,0)")


def expired_archives(manifest: DataFrame, now: str | dt.date | dt.datetime) -> DataFrame:
    """Manifest rows whose archives may be dropped at ``now``; dropping is the caller's."""
    moment = now if isinstance(now, dt.datetime) else as_date(now)
    return manifest.where(F.col("expires_at") <= F.lit(moment).cast("timestamp_ntz"))


def droppable_copies(copies: Sequence[Archive], archives: Sequence[Archive]) -> list[Archive]:
    """Working copies whose quarter is archived, and which can therefore go."""
    kept = {(a.table, a.start, a.end) for a in archives if a.kind == "snapshot"}
    return [c for c in copies if c.kind == "copy" and (c.table, c.start, c.end) in kept]
