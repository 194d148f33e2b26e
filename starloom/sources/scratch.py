"""Intermediate tables in the folder the cluster shares for checkpoints.

An operator that numbers rows must not see them reshuffled by a recomputed
task. Such rows are written as parquet under ``spark.checkpoint.dir``, which
every executor reaches and which outlives any of them; reading back is columnar
and prunes. The folder's retention is the cluster's business.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_temporary = ""


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode.

    The session is left as it is: the temporary folder is this process's own.
    """
    global _temporary
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    _temporary = _temporary or tempfile.mkdtemp(prefix="starloom-")
    return _temporary


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no other call gives out."""
    return f"{scratch_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and return it as read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
