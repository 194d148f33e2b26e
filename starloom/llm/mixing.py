"""Sampling documents so that their tokens meet target shares by source, language and topic.

Only DataFrame functions run here. Tokens are counted per cell (source,
language, topic), and iterative proportional fitting rakes the cells' inclusion
probabilities to the target totals of each margin in turn, never above one.
Each document is then kept with its cell's probability, by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.shared import BROADCAST_BYTES, written

MARGINS = ("source", "lang", "topic")
# Target shares are the shares of tokens to this power, scaled to one: the
# smaller it is, the more a dominant source gives way to others.
FLATTEN = 0.7
# The expected share of all tokens that is kept.
RATE = 0.7
SWEEPS = 12
SEED = 42
# Up to so many cells are raked in one partition, without a shuffle.
CELLS_TOGETHER = 200_000
# Bytes of a cell in a broadcast.
CELL_BYTES = 200


def token_count(text: Column) -> Column:
    """Words of a text, runs of anything but white space; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def form_of(text: Column) -> Column:
    """A topic read off the text itself: what kind of content it is."""
    return (
        F.when(text.isNull() | (F.btrim(text) == ""), "empty")
        .when(text.contains(" | "), "table")
        .when(text.contains("!! "), "shouting")
        .when(text.rlike(r"[#$%&*]{3}"), "symbols")
        .when(text.rlike(r"[Ll]icen[sc]e|[Cc]opyright"), "legal")
        .when(F.length(text) < 600, "short")
        .when(F.length(text) < 6000, "article")
        .otherwise("long")
    )


def draw(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that the seed and a row's values decide."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def flattened(cells: DataFrame, name: str, power: float = FLATTEN, rate: float = RATE) -> DataFrame:
    """Target tokens of each value of a margin: ``rate`` of all, by shares to a power."""
    sums = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("tokens"))
    powers = F.pow("tokens", F.lit(power))
    total, of_powers = sums.agg(F.sum("tokens"), F.sum(powers)).head()
    scale = rate * total / of_powers if of_powers else 0.0
    return sums.select(name, (powers * scale).alias("target"))


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    sweeps: int = SWEEPS,
    together: int = CELLS_TOGETHER,
) -> DataFrame:
    """``cells`` (margin columns, ``tokens``) with an inclusion ``probability`` each.

    ``targets`` has for each margin a table of its values and ``target``, the
    tokens wanted of it; together each margin wants the same total. Each sweep
    scales the cells of every margin's value to its target and cuts
    probabilities at one, so a target beyond what there is takes all of it.
    Cells without tokens keep the probability they start with, the share of the
    total that is wanted.
    """
    now = cells
    for name, wanted in targets.items():
        wanted = wanted.select(F.col(name).alias("__v"), F.col("target").alias(f"__{name}"))
        now = now.join(wanted, now[name].eqNullSafe(wanted["__v"]), "left").drop("__v")
    asked = next(iter(targets.values())).agg(F.sum("target")).head()[0] or 0.0
    there = cells.agg(F.sum("tokens")).head()[0] or 0
    start = min(1.0, asked / there) if there else 1.0
    now = written(now.withColumn("probability", F.lit(start)), "cells")
    few = now.count() <= together
    # In one partition a window needs no exchange. Many cells are added up by
    # hash instead, as a margin's value may hold most of them.
    now = now.coalesce(1) if few else now
    for _ in range(sweeps):
        for name in targets:
            if few:
                sums = F.sum(F.col("tokens") * F.col("probability"))
                now = now.withColumn("__sum", sums.over(Window.partitionBy(name)))
            else:
                sums = now.groupBy(F.col(name).alias("__v")).agg(
                    F.sum(F.col("tokens") * F.col("probability")).alias("__sum")
                )
                now = now.join(sums, now[name].eqNullSafe(sums["__v"])).drop("__v")
            scaled = F.col("probability") * F.col(f"__{name}") / F.col("__sum")
            kept = F.when(F.col("__sum") > 0, F.least(scaled, F.lit(1.0))).otherwise(F.col("probability"))
            now = now.withColumn("probability", kept).drop("__sum")
            now = now if few else written(now, "raked")
    return now.drop(*[f"__{name}" for name in targets])


def _cells(rows: DataFrame) -> DataFrame:
    return written(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")


def _with_probability(rows: DataFrame, cells: DataFrame, power: float, rate: float, sweeps: int) -> DataFrame:
    """``rows`` with the raked probability of each row's cell."""
    targets = {name: flattened(cells, name, power, rate) for name in MARGINS}
    raked = rake(cells, targets, sweeps)
    raked = written(raked.select(*[F.col(c).alias(f"__{c}") for c in MARGINS], "probability"), "raked")
    if raked.count() * CELL_BYTES <= BROADCAST_BYTES:
        raked = F.broadcast(raked)
    fits = F.lit(True)
    for c in MARGINS:
        fits = fits & rows[c].eqNullSafe(raked[f"__{c}"])
    return rows.join(raked, fits).drop(*[f"__{c}" for c in MARGINS])


def weigh_documents(
    docs: DataFrame,
    power: float = FLATTEN,
    rate: float = RATE,
    seed: int = SEED,
    sweeps: int = SWEEPS,
    topic: Callable[[Column], Column] = form_of,
) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, probability, kept`` for every row of ``docs``.

    Null sources and languages are values of their own; a document without
    words has no tokens and is kept with its cell's probability. Rows that
    repeat id and text are kept or left together. An empty table gives no rows.
    Other columns are not read.
    """
    text = F.col("text")
    marked = written(
        docs.select(
            "doc_id", "source", "lang", topic(text).alias("topic"), token_count(text).alias("tokens"),
            draw(seed, "doc_id", "text").alias("draw"),
        ),
        "tokens",
    )
    weighed = _with_probability(marked, _cells(marked), power, rate, sweeps)
    return weighed.withColumn("kept", F.col("draw") < F.col("probability")).drop("draw")


def mixed(
    docs: DataFrame,
    power: float = FLATTEN,
    rate: float = RATE,
    seed: int = SEED,
    sweeps: int = SWEEPS,
    topic: Callable[[Column], Column] = form_of,
) -> DataFrame:
    """The sampled rows of ``docs``, whole: those that :func:`weigh_documents` marks as kept.

    Other columns are passed through.
    """
    text = F.col("text")
    counted = docs.select("source", "lang", topic(text).alias("topic"), token_count(text).alias("tokens"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), "source", "lang", topic(text).alias("topic"),
        draw(seed, "doc_id", "text").alias("draw"),
    )
    weighed = _with_probability(rows, _cells(counted), power, rate, sweeps)
    return weighed.where(F.col("draw") < F.col("probability")).select("row.*")
