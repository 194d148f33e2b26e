"""The suspense cycle of late-arriving dimensions over a stream of facts.

Each micro-batch is one cycle. It reads what the round before left suspended,
writes its own facts once, ready and suspended apart, and never touches an
older cycle. A round counts from its commit record on, which is written last,
under ``_commits/<cycle>/<round>``: released facts and the next cycle go by the
records alone. So a batch repeated after a failure is either found committed and
left as it is, with the rounds that followed it, or its data counted for nobody
and is written anew. No fact is released twice.

A batch looks at the records of its own and the neighbouring cycles only,
however many there are.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.late import (
    PROCESSED,
    is_processed,
    land_cycle,
    resolve_cycle,
    stored_cycle,
)
from starloom.operators.star import DimensionKey

_RECORD = "cycle LONG, round LONG"

KeySource = Callable[[SparkSession], Sequence[DimensionKey]]


def start_late_feed(
    raw: DataFrame, keys: KeySource, root: str, checkpoint: str
) -> StreamingQuery:
    """Process what the stream ``raw`` holds now, then stop.

    ``keys`` is called in every cycle, to see dimensions that arrived meanwhile.
    A ``root`` belongs to the stream with the ``checkpoint`` it was first used
    with; another one, which would start anew over its cycles, is refused.
    Without new facts no cycle runs; see :func:`release_waiting`.
    """
    _claim(raw.sparkSession, root, checkpoint)

    def cycle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _last_round(spark, root, batch_id) is not None:
            return
        if _last_round(spark, root, batch_id + 1) is not None:
            raise ValueError(f"{root} holds cycles after {batch_id}; its checkpoint is not this stream's")
        before = _last_round(spark, root, batch_id - 1) if batch_id else None
        if batch_id and before is None:
            raise ValueError(f"{root} lacks the cycle before {batch_id}; its checkpoint is not this stream's")
        found = keys(spark)
        waiting = _waiting(spark, root, (batch_id - 1, before), raw, found) if batch_id else None
        land_cycle(resolve_cycle(batch, waiting, found), _path(root, batch_id, 0), "overwrite")
        if batch_id and _last_round(spark, root, batch_id - 1) != before:
            raise RuntimeError(f"waiting facts were released while cycle {batch_id} ran; start it again")
        _commit(spark, root, batch_id, 0)

    return (
        raw.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def release_waiting(raw: DataFrame, keys: KeySource, root: str) -> int:
    """Look the waiting facts up again without new ones, and land them as a further round.

    For when dimensions arrived and no fact did. ``raw`` only gives the facts'
    columns. Returns how many were released; nothing is written if none were.
    """
    spark = raw.sparkSession
    last = _records(spark, root).agg(F.max(F.struct("cycle", "round")).alias("last")).head()["last"]
    if last is None:
        return 0
    cycle, number, found = last["cycle"], last["round"], keys(spark)
    waiting = _waiting(spark, root, (cycle, number), raw, found)
    nothing = spark.createDataFrame([], raw.schema)
    # Without a record the directory counts for nobody, also if this is given up.
    ready, _ = land_cycle(resolve_cycle(nothing, waiting, found), _path(root, cycle, number + 1), "overwrite")
    released = ready.count()
    if released:
        if _last_round(spark, root, cycle + 1) is not None or _last_round(spark, root, cycle) != number:
            raise RuntimeError(f"another round followed cycle {cycle} meanwhile; release again")
        _commit(spark, root, cycle, number + 1)
    return released


def released_facts(spark: SparkSession, root: str) -> DataFrame:
    """All facts released so far, with the ``cycle`` that released them.

    Only the partitions of ready facts are read.
    """
    cycles = spark.read.option("basePath", root).parquet(root)
    ready = cycles.where(F.col(PROCESSED).cast("boolean")).drop(PROCESSED)
    counting = _records(spark, root).select(F.col("cycle").cast("int"), F.col("round").cast("int"))
    return ready.join(counting, ["cycle", "round"], "left_semi").drop("round")


def _path(root: str, batch_id: int, number: int) -> str:
    return f"{root}/cycle={batch_id}/round={number}"


def _waiting(
    spark: SparkSession, root: str, place: tuple[int, int], raw: DataFrame, keys: Sequence[DimensionKey]
) -> DataFrame:
    stored = stored_cycle(spark, _path(root, *place), _schema(raw, keys))
    return stored.where(~is_processed())


def _commit(spark: SparkSession, root: str, cycle: int, number: int) -> None:
    """Note that a round is complete. A record cut short by a failure is replaced."""
    record = spark.createDataFrame([(cycle, number)], _RECORD).coalesce(1)
    record.write.mode("overwrite").parquet(f"{root}/_commits/{cycle}/{number}")


def _records(spark: SparkSession, root: str, cycle: int | None = None) -> DataFrame:
    """The rounds that count, of one cycle or of all."""
    path = f"{root}/_commits" if cycle is None else f"{root}/_commits/{cycle}"
    try:
        return spark.read.schema(_RECORD).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], _RECORD)


def _last_round(spark: SparkSession, root: str, cycle: int) -> int | None:
    return _records(spark, root, cycle).agg(F.max("round")).head()[0]


def _claim(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Note which stream's ``root`` this is, or raise if it is another's."""
    note = f"{root}/_stream"
    try:
        owner = spark.read.text(note).head()[0]
    except AnalysisException:
        spark.createDataFrame([(checkpoint,)], "checkpoint STRING").write.text(note)
        return
    if owner != checkpoint:
        raise ValueError(f"{root} belongs to the stream with the checkpoint {owner}")


def _schema(raw: DataFrame, keys: Sequence[DimensionKey]) -> T.StructType:
    """Columns of a resolved cycle: the facts', optional keys, required keys, the flag."""
    ordered = sorted(keys, key=lambda key: key.required)
    fields = [key.dim.schema[key.sk] for key in ordered]
    nullable = [T.StructField(f.name, f.dataType) for f in [*raw.schema.fields, *fields]]
    return T.StructType([*nullable, T.StructField(PROCESSED, T.BooleanType())])
