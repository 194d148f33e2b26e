"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Each of ``PERMUTATIONS`` hash functions gives two signature values, its minimum
and its maximum over a document's shingles, at the price of one evaluation per
shingle. Both agree between two documents with their resemblance as
probability, so the values are banded and compared like those of twice as many
functions, with a lower variance.

With 32 bands of four values a pair at resemblance 0.75 shares no band with
probability 0.684**32 = 5e-6 (1e-4 for sets of two or three shingles, where
minimum and maximum depend on each other), and less above it. Every pair that
does share a band is either in one component already, or compared.

* Documents with equal shingle sets are one node from the start, so groups of
  exact copies are never expanded.
* First each member of a band's bucket is compared with two pivots, the
  bucket's smallest and largest node.
* Buckets that still hold several components are then searched for links
  across them. One task gets a bucket's full sets, counts the common hashes of
  all its pairs by a product of incidence matrices, and hands on only links that
  join components not yet joined in it: fewer than the bucket has components,
  however many pairs are near misses. Buckets of the same members are searched
  once. Very large buckets are cut by a second band first: a linked pair shares
  one of the other 31 with probability 1 - 8e-6. What is large even then is
  searched in pairs of blocks. Nothing is capped.
* Links are told by full sets of 64-bit shingle hashes, never by signatures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.components import connected_components
from starloom.llm.shared import BROADCAST_BYTES, keep_only, written
from starloom.llm.wordhash import mix, shingle_sets

PERMUTATIONS = 64
BANDS = 32
SIMILARITY = (75, 100)
# Open buckets beyond this are cut by a second band; groups are searched in
# blocks of this many members, or as many as have so many shingles.
LARGE = 4096
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21
# Cells of an incidence matrix held at a time.
CELLS = 1 << 23

_VALUES = 2 * PERMUTATIONS
_RANDOM = np.random.default_rng(75_100)
_TIMES = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_ROWS = 2048


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of each hash function over a set's hashes, side by side."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), _ROWS):
        values = shingles[at : at + _ROWS, None] * _TIMES + _PLUS
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of signature values."""
    rows = signatures.reshape(len(signatures), BANDS, _VALUES // BANDS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for j in range(rows.shape[2]):
        keys = mix(keys ^ rows[:, :, j])
    return keys


def _node(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingle hashes."""
    sums = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return b"".join(int(s).to_bytes(8, "big") for s in sums)


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            sets = shingle_sets(batch.column(1).to_pylist())
            some = [s for s in sets if len(s)]
            signed = np.array([signature(s) for s in some], np.uint64).reshape(-1, _VALUES)
            bands = iter(band_keys(signed).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "node", "bands"],
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            sets = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["node", "hashes"],
            )


def mark_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, bands`` per row of ``docs``, in one pass.

    ``node`` names the shingle set; it and what follows are null without words.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(_marks, schema)


def near_duplicates(
    docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, large: int = LARGE
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if their sets of five-word shingles have a resemblance
    of ``similarity`` (numerator, denominator; from 0.75 up) or more.
    ``component_id`` is the smallest id in reach of links; a document is kept if
    that is its own. A document without words, or with null text, is its own
    component. Null ids count as the largest; rows that repeat an id are linked
    by their texts like others. An empty table gives no rows. Other columns are
    not read.
    """
    return _components(docs, similarity, large).drop("text_hash", "root")


def _components(
    docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, large: int = LARGE
) -> DataFrame:
    marks = written(mark_documents(docs), "marks")
    nodes = written(
        marks.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    members = nodes.select("node", "n", F.explode("bands").alias("band"))
    pairs = written(_pivot_pairs(members, similarity), "pairs")
    if not pairs.isEmpty():
        sets = _sets(docs, nodes, members)
        links = written(_confirmed(pairs, sets, similarity), "links")
        roots = written(connected_components(links), "roots")
        rest = written(_links_across(nodes, roots, sets, similarity, large), "links")
        if not rest.isEmpty():
            # Within the old components each node is tied to its root, which is enough.
            tied = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = written(connected_components(tied.unionByName(rest)), "roots")
        homes = roots.join(nodes.select("node", "doc_id"), "node")
        first = homes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        found = homes.join(first, "root").select("node", "root", "component_id")
        names = nodes.select("node", "doc_id").join(found, "node", "left")
        names = names.select(
            "node", F.coalesce("root", "node").alias("root"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    else:
        names = nodes.select("node", F.col("node").alias("root"), F.col("doc_id").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return marks.join(names, "node", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "root",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _sizes_fit(a: str, b: str, similarity: tuple[int, int]):
    """Sets whose sizes differ more than this cannot be similar enough."""
    top, bottom = similarity
    return F.least(a, b) * F.lit(bottom) >= F.greatest(a, b) * F.lit(top)


def _pivot_pairs(members: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Each member of a bucket with the bucket's smallest and largest node."""
    row = F.struct("node", "n")
    pivots = members.groupBy("band").agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
    pivots = pivots.where("lo.node <> hi.node")
    both = members.join(pivots, "band").select(
        "node", "n", F.explode(F.array("lo", "hi")).alias("pivot")
    )
    return (
        both.where((F.col("node") != F.col("pivot.node")) & _sizes_fit("n", "pivot.n", similarity))
        .select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b"))
        .distinct()
    )


def _sets(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``node, hashes`` of the nodes that share a bucket with another one."""
    shared = members.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = shared.where("lo <> hi").select("band")
    needed = members.join(shared, "band", "left_semi").select("node").distinct()
    needed = written(nodes.select("node", "doc_id").join(needed, "node", "left_semi"), "needed")
    again = keep_only(docs.select("doc_id", "text"), needed, "doc_id", limit=BROADCAST_BYTES)
    rows = again.select("text").mapInArrow(_set_rows, "node binary, hashes array<bigint>")
    rows = rows.join(needed.select("node"), "node", "left_semi")
    return written(rows.groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    top, bottom = similarity
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("x").alias("p"), F.size("y").alias("q"),
        F.size(F.array_intersect("x", "y")).cast("long").alias("common"),
    )
    return both.where(
        F.col("common") * bottom >= (F.col("p") + F.col("q") - F.col("common")) * top
    ).select("a", "b")


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's sizes.

    Of buckets with the same members, told by a sum over them, one is left.
    """
    held = members.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.sum("n").alias("volume"), F.bit_xor(F.xxhash64("node")).alias("same"),
    )
    held = held.where("lo <> hi").groupBy("size", "volume", "same").agg(F.min("key").alias("key"))
    return members.join(held.drop("same"), "key")


def _links_across(
    nodes: DataFrame, roots: DataFrame, sets: DataFrame, similarity: tuple[int, int], large: int
) -> DataFrame:
    """``a, b``: links that tie components which share a bucket wherever any of their members are linked."""
    known = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = known.select("node", "root", "n", F.explode("bands").alias("key"))
    opened = written(_open(members), "open")
    few = opened.where(F.col("size") <= large)
    # A second band cuts large buckets; its key names both bands, in order.
    many = opened.where(F.col("size") > large).select("node", "root", "n", "key")
    cut = (
        many.join(nodes.select("node", F.explode("bands").alias("other")), "node")
        .where("key <> other")
        .select("node", "root", "n", F.xxhash64(F.least("key", "other"), F.greatest("key", "other")).alias("key"))
        .distinct()
    )
    groups = few.unionByName(_open(cut))
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(BLOCK)), F.ceil(F.col("volume") / F.lit(BLOCK_SHINGLES)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # Each member goes to every pair of blocks that its own block is part of.
    spread = (
        groups.withColumn("blocks", blocks.cast("int"))
        .withColumn("own", own)
        .withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("own", "peer"), F.greatest("own", "peer")).alias("group"), "node", "root"
        )
        .join(sets, "node")
    )
    top, bottom = similarity
    found = spread.repartition("group").sortWithinPartitions("group").mapInArrow(
        lambda batches: _linked(batches, top, bottom), "a binary, b binary"
    )
    return found.distinct()


def _linked(batches: Iterator[pa.RecordBatch], top: int, bottom: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal groups; the last run waits for the next batch."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        groups = batch.column("group").to_numpy()
        if not len(groups):
            continue
        starts = [0, *(np.flatnonzero(np.diff(groups)) + 1), len(groups)]
        if waiting and waiting[0].column("group")[0].as_py() != groups[0]:
            yield _link_batch(_tied(pa.Table.from_batches(waiting), top, bottom))
            waiting = []
        out: list[tuple[bytes, bytes]] = []
        for start, end in zip(starts, starts[1:]):
            waiting.append(batch.slice(start, end - start))
            if end < len(groups):
                out += _tied(pa.Table.from_batches(waiting), top, bottom)
                waiting = []
        yield _link_batch(out)
    if waiting:
        yield _link_batch(_tied(pa.Table.from_batches(waiting), top, bottom))


def _common(hashes: np.ndarray, owners: np.ndarray, few: np.ndarray, n: int) -> np.ndarray:
    """How many hashes each member in ``few`` has in common with each of the ``n`` members."""
    values, columns, times = np.unique(hashes, return_inverse=True, return_counts=True)
    common = np.zeros((len(few), n), np.float32)
    # Hashes of one member alone are common to none.
    shared = np.flatnonzero(times > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    columns = place[columns]
    order = np.argsort(columns, kind="stable")
    columns, owners = columns[order], owners[order]
    wide = max(1, CELLS // n)
    for low in range(0, len(shared), wide):
        part = slice(*np.searchsorted(columns, [low, low + wide]))
        cells = np.zeros((n, min(wide, len(shared) - low)), np.float32)
        cells[owners[part], columns[part] - low] = 1
        common += cells[few] @ cells.T
    return common


def _tied(table: pa.Table, top: int, bottom: int) -> list[tuple[bytes, bytes]]:
    """Links by which the components in one group hang together: fewer than components.

    Common hashes are whole numbers below 2**24, which single precision keeps.
    """
    names = table["node"].to_pylist()
    labels = np.unique(np.array(table["root"].to_pylist(), "S16"), return_inverse=True)[1]
    column = table["hashes"].combine_chunks()
    hashes, n = column.flatten().to_numpy(), len(names)
    sizes = column.value_lengths().to_numpy().astype(np.int64)
    # Members of the largest component are compared with those outside it only.
    few = np.flatnonzero(labels != np.bincount(labels).argmax())
    if not len(few):
        return []
    common = _common(hashes, np.repeat(np.arange(n), sizes), few, n)
    out = []
    for i, row in zip(few, common):
        linked = row.astype(np.int64) * (bottom + top) >= (sizes[i] + sizes) * top
        while len(others := np.flatnonzero(linked & (labels != labels[i]))):
            j = others[0]
            out.append((min(names[i], names[j]), max(names[i], names[j])))
            labels[labels == labels[j]] = labels[i]
    return out


def _link_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def deduplicated(docs: DataFrame, unlike_apart: bool = False) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Of rows that repeat an id one stays. With ``unlike_apart`` that holds only
    within linked rows: texts that are not linked both stay, though they share
    an id; texts without words count as one. Rows without an id are told apart
    by their text. Extra columns are passed through.
    """
    found = written(_components(docs), "components")
    dropped = found.where("not kept").select("doc_id")
    # Rows that repeat an id are decided by their text as well.
    repeated = written(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    once = keep_only(docs, dropped.unionByName(repeated), "doc_id", "left_anti")
    if repeated.isEmpty():
        return once
    keep = keep_only(found.where("kept"), repeated, "doc_id").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("root").alias("__root")
    ).distinct()
    again = keep_only(docs, repeated, "doc_id").withColumn("__text", F.xxhash64("text"))
    again = again.join(
        keep, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    ).drop("__id", "__hash").dropDuplicates(["doc_id", "__text"])
    one = ["doc_id", "__root"] if unlike_apart else ["doc_id"]
    named = again.where("doc_id is not null").dropDuplicates(one)
    return once.unionByName(named.unionByName(again.where("doc_id is null")).drop("__text", "__root"))
