"""How far the sources of a language differ, term by term and pair by pair.

Each language keeps the terms of at least three of its documents. A source's
share of a term is a whole number of billionths, smoothed by one occurrence, and
the divergence of shares p from q is the sum of floor((p - q)**2 / q).

The sum over a pair of sources runs over runs instead of terms. A term is
represented by its shares in all sources; terms alike in all of them are one
column with a length, and the columns are dealt over blocks of bounded size. In
a block they are ordered, so that equal shares stand side by side, each
source's shares are run-length encoded, and for each pair the boundaries of
both encodings are intersected: every piece counts once, times its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.shared import BROADCAST_BYTES, pieces_of, written

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
# Shares in one block of columns.
BLOCK_SHARES = 1 << 20
# Partial counts held by a task before they are handed on.
HELD_TERMS = 400_000

_LETTERS = set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
# Bytes of UTF-8: anything but a term becomes a space, and A-Z lower case.
_TERM_BYTES = bytes(
    (b | 0x20 if 0x41 <= b <= 0x5A else b) if b in _LETTERS else 0x20 for b in range(256)
)


def _term_lists(text: str) -> Iterator[list[bytes]]:
    """The terms of ``text`` in order, in lists of bounded size."""
    for piece in pieces_of(text.encode("utf-8").translate(_TERM_BYTES)):
        yield piece.split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for text, lang, source in zip(*(column.to_pylist() for column in batch.columns)):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(occurrences)
            seen: set[bytes] = set()
            for terms in _term_lists(text):
                occurrences.update(terms)
                documents.update(set(terms) - seen)
                seen.update(terms)
            size += len(occurrences)
            if size >= HELD_TERMS:
                yield from _partial(held)
                held, size = {}, 0
    yield from _partial(held)


def _partial(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (occurrences, documents) in held.items():
        n = len(occurrences)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                pa.array([source] * n, pa.string()),
                pa.array(list(occurrences), pa.binary()).cast(pa.string()),
                pa.array(occurrences.values(), pa.int64()),
                pa.array([documents[term] for term in occurrences], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term and the documents that have it."""
    partial = docs.select("text", "lang", "source").na.fill("").mapInArrow(
        _counted, "lang string, source string, term string, n bigint, docs bigint"
    )
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _div(a: Column, b: Column) -> Column:
    """The whole part of a quotient, exactly."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)) for counts of any size; null without terms."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return _div(product, F.nullif(total + terms, F.lit(0)).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); shares are at most SCALE + 1, so that nothing overflows."""
    return _div((p - q) * (p - q), q)


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, lang_n`` of the terms in at least ``least`` documents of the language."""
    sums = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    return sums.where(F.col("docs") >= least).drop("docs")


def _small(df: DataFrame, rows: int, row_bytes: int = 256) -> DataFrame:
    """``df`` to be broadcast if its counted ``rows`` fit, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def with_shares(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """The shares of terms that occur, and the groups: both written.

    ``lang, source, term, p, q``: of each kept term that the group has, the share
    in the group and in the language. ``lang, source, terms, none``: of each
    group the number of kept terms and the share of a term that it does not have.
    """
    docs = docs.select("text", "lang", "source").na.fill("")
    counts = written(count_terms(docs), "terms")
    kept = written(kept_terms(counts, least), "kept")
    here = written(counts.drop("docs").join(kept, ["lang", "term"]), "occurring")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = here.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = written(
        groups.withColumn("none", share(F.lit(0), F.col("total"), F.col("terms"))), "groups"
    )
    shares = here.join(_small(groups.drop("none"), groups.count()), ["lang", "source"]).select(
        "lang", "source", "term",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    return written(shares, "shares"), groups


def share_columns(shares: DataFrame) -> DataFrame:
    """``lang, column, length``: terms alike in all sources as one column of (source, p).

    A column has an entry for each source that has the term, by source.
    """
    columns = shares.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("source", "p"))).alias("column")
    )
    return columns.groupBy("lang", "column").agg(F.count(F.lit(1)).alias("length"))


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _block_sums(columns: pa.Table, groups: pa.Table) -> pa.Table:
    """For each ordered pair of a block's groups the sum over the block's runs."""
    order = np.argsort(groups["source"].to_numpy(zero_copy_only=False))
    sources = groups["source"].take(pa.array(order)).to_pylist()
    none = groups["none"].to_numpy()[order]
    place = {source: i for i, source in enumerate(sources)}
    rows = sorted(
        ([(e["source"], e["p"]) for e in column], length)
        for column, length in zip(columns["column"].to_pylist(), columns["length"].to_pylist())
    )
    ends = np.cumsum([length for _, length in rows], dtype=np.int64)
    entries: list[tuple[list[int], list[int]]] = [([], []) for _ in sources]
    for at, (column, _) in enumerate(rows):
        for source, p in column:
            where, values = entries[place[source]]
            where.append(at)
            values.append(p)
    starts, heights = [], []
    for (where, values), empty in zip(entries, none):
        whole = np.full(len(rows), empty, np.int64)
        whole[where] = values
        runs = _runs(whole) if len(rows) else np.zeros(0, np.int64)
        starts.append(runs)
        heights.append(whole[runs])
    before = np.concatenate([[0], ends])
    out = []
    for i, p_starts in enumerate(starts):
        sums = np.zeros(len(sources), np.int64)
        for j, q_starts in enumerate(starts):
            if i != j and len(rows):
                cuts = np.union1d(p_starts, q_starts)
                p = heights[i][np.searchsorted(p_starts, cuts, "right") - 1]
                q = heights[j][np.searchsorted(q_starts, cuts, "right") - 1]
                length = np.diff(before[np.append(cuts, len(rows))])
                sums[j] = ((p - q) ** 2 // q * length).sum()
        others = np.arange(len(sources)) != i
        out.append(
            pa.table(
                {
                    "lang": pa.array([groups["lang"][0].as_py()] * (len(sources) - 1), pa.string()),
                    "source": pa.array([sources[i]] * (len(sources) - 1), pa.string()),
                    "item": pa.array([s for s, other in zip(sources, others) if other], pa.string()),
                    "value": pa.array(sums[others], pa.int64()),
                }
            )
        )
    return pa.concat_tables(out)


def pair_divergences(columns: DataFrame, groups: DataFrame, block: int = BLOCK_SHARES) -> DataFrame:
    """``lang, source, item, value`` for each source and each other source of its language.

    ``block`` bounds the shares that one task holds at a time.
    """
    blocks = columns.groupBy("lang").agg(
        F.ceil(F.sum(F.size("column")) / F.lit(block)).cast("int").alias("blocks")
    )
    blocks = groups.select("lang").distinct().join(blocks, "lang", "left").na.fill(1)
    blocks = written(blocks, "blocks")
    blocks = _small(blocks, blocks.count())
    dealt = columns.join(blocks, "lang").withColumn(
        "block", F.pmod(F.xxhash64("column"), F.col("blocks")).cast("int")
    )
    everywhere = groups.join(blocks.withColumnRenamed("blocks", "of"), "lang").select(
        "lang", "source", "none", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("block")
    )
    sums = (
        dealt.groupBy("lang", "block")
        .cogroup(everywhere.groupBy("lang", "block"))
        .applyInArrow(_block_sums, "lang string, source string, item string, value bigint")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(items: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return items.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit_sources(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, block: int = BLOCK_SHARES
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) of ``docs``.

    Part ``pair`` ranks the language's other sources by divergence from them, part
    ``term`` the ``top`` terms that the source has in a larger share than its
    language. Null texts, languages and sources count as empty; a group without
    terms is compared like any other, and in a language that keeps no term every
    value is 0. Of equal values the item that is smaller in UTF-8 comes first.
    Repeated rows count each. An empty table gives no rows. Other columns are not read.
    """
    shares, groups = with_shares(docs, least)
    columns = written(share_columns(shares), "columns")
    pairs = _ranked(pair_divergences(columns, groups, block), "pair")
    terms = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )
    return pairs.unionByName(_ranked(terms, "term").where(F.col("rank") <= top))
