"""Readers and writers for the table formats the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from starloom.sources.scratch import materialize

# Holds the text of a line that does not fit the schema.
MALFORMED = "malformed_line"


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line and a declared schema.

    ``enforceSchema=false`` checks the header against the schema (ignoring
    case), so a feed with swapped columns fails instead of loading wrongly. A
    line with a value of another type, or with too few or too many values,
    fails the read, also where its columns are not used.
    """
    return _csv(spark, schema).option("mode", "FAILFAST").csv(path)


def read_csv_apart(
    spark: SparkSession, path: str, schema: StructType | str
) -> tuple[DataFrame, DataFrame]:
    """A CSV's well-formed lines, and the others with their text in ``malformed_line``.

    The second frame also has what values could be read. Every line of the file
    is in one of the two, which are parsed once, when called, to scratch.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_text = StructType([*declared.fields, StructField(MALFORMED, StringType())])
    lines = (
        _csv(spark, with_text)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )
    lines = materialize(lines, "csv")
    fits = lines[MALFORMED].isNull()
    return lines.where(fits).select(*declared.names), lines.where(~fits)


def _csv(spark: SparkSession, schema: StructType | str) -> DataFrameReader:
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("columnPruning", False)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; never write to the path ``df`` is read from."""
    df.write.mode(mode).option("header", True).csv(path)


def write_dimension(df: DataFrame, path: str, current_flag: str = "is_current") -> None:
    """One version of a slowly changing dimension in a new directory.

    Parquet has no in-place update, so each load writes beside the last one.
    Partitioning by the current flag lets the next load read only current rows
    for its join and copy the history without a shuffle.
    """
    df.write.mode("errorifexists").partitionBy(current_flag).parquet(path)


def save_dimension(
    df: DataFrame, name: str, key: str, buckets: int, current_flag: str = "is_current"
) -> None:
    """One version of a dimension as a new catalog table, bucketed by ``key``.

    The next load then joins its snapshot to the current rows without shuffling
    the dimension. Rows are brought together by bucket before they are written,
    which makes one file per bucket and flag.
    """
    (
        df.repartition(buckets, key)
        .write.mode("errorifexists")
        .partitionBy(current_flag)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def read_dimension(spark: SparkSession, path: str, current_flag: str = "is_current") -> DataFrame:
    """A dimension as :func:`write_dimension` left it.

    Partition values come back from directory names as text; filters on the
    flag, a cast of it, still prune directories.
    """
    stored = spark.read.parquet(path)
    return stored.withColumn(current_flag, stored[current_flag].cast("boolean"))


def read_table_list(spark: SparkSession, path: str) -> list[str]:
    """Table names from the first column of a control CSV with a header."""
    listed = spark.read.option("header", True).csv(path)
    name = listed.columns[0]
    return [row[0] for row in listed.select(name).na.drop().collect()]


def partition_column(spark: SparkSession, table: str) -> str:
    """Name of the one partition column of a catalog table."""
    found = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if len(found) != 1:
        raise ValueError(f"{table} has {len(found)} partition columns; name the date column")
    return found[0]
