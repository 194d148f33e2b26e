"""Benchmark passages in documents, found by SimHash over windows sized to the items.

Only DataFrame functions run here. Each benchmark item is indexed by the
64-bit SimHash of all its windows of one size, the largest that any passage
similar enough must contain unbroken (``WINDOW_SIZES``); documents are cut into
windows of the same size. A SimHash is the bitwise majority of a window's
five-word shingle hashes, which are added up with bit-sliced adders on whole
longs. Fingerprints are cut into ``RADIUS + 1`` blocks: two within the radius
agree in one block at least, so a lookup by blocks finds all of them.

Where a window is found, all windows of the item's length around it are
compared with the item by the weighted Jaccard similarity of their five-word
shingles, a shingle's weight being how often it occurs. An occurrence counts in
the windows of one run of starts, so the ends of those runs give every window's
common weight.

For a similarity of 0.75, at most a seventh of the shingles may differ. A word
changed inside the passage costs five shingles and a place where parts are cut,
left out or put in another order costs four, so some run of unbroken words is
long enough to hold one of the windows exactly: 10 words of an item of 12, 16 of
one of 24 or more. An item that repeats four or more words within itself may be
put in another order there without any such break; then no run need be so long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.shared import BROADCAST_BYTES, keep_only, written

SHINGLE = 5
SIMILARITY = (75, 100)
RADIUS = 3
# Items of so many words or more are searched by windows of so many words, which
# start at every so manieth word of a document. Shorter items by their length.
# Size and step less one are together the longest unbroken run to count on.
WINDOW_SIZES = ((24, 13, 4), (12, 8, 3), (5, 5, 1), (4, 4, 1), (3, 3, 1), (2, 2, 1), (1, 1, 1))
# Bytes of one index row in a broadcast, with its hash-map entry.
INDEX_ROW_BYTES = 100


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words of a text; none for null."""
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[ \\t-\\r]+")
    )
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def _windows(df: DataFrame, size: int, step: int) -> DataFrame:
    """A row per window of ``size`` words in the array ``h``, with ``start`` and SimHash ``f``."""
    last = F.size("h") - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)))
    rows = df.withColumn("start", F.explode(starts))
    k = min(SHINGLE, size)
    features = {
        f"x{i}": F.xxhash64(*[F.get("h", F.col("start") + i + j) for j in range(k)])
        for i in range(size - k + 1)
    }
    keep = [*df.columns, "start"]
    return _majority(rows.select(*keep, *[x.alias(c) for c, x in features.items()]), list(features), keep)


def _majority(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Replace ``features`` by ``f``, whose bits are set where over half of theirs are.

    Plane p holds the columns whose bits count 2**p. Three of one plane are
    replaced by their sum and their carry until each plane has one.
    """
    planes: list[list[str]] = [list(features)]
    made = 0
    while any(len(plane) > 1 for plane in planes):
        new: dict[str, Column] = {}
        after: list[list[str]] = [[] for _ in range(len(planes) + 1)]
        for p, plane in enumerate(planes):
            for i in range(0, len(plane), 3):
                group = plane[i : i + 3]
                if len(group) == 1 or (len(group) == 2 and len(plane) > 2):
                    after[p] += group
                    continue
                a, b = F.col(group[0]), F.col(group[1])
                half = a.bitwiseXOR(b)
                carry = a.bitwiseAND(b)
                if len(group) == 3:
                    c = F.col(group[2])
                    carry = carry.bitwiseOR(half.bitwiseAND(c))
                    half = half.bitwiseXOR(c)
                new[f"s{made}"], new[f"c{made}"] = half, carry
                after[p].append(f"s{made}")
                after[p + 1].append(f"c{made}")
                made += 1
        planes = after if after[-1] else after[:-1]
        names = [c for plane in planes for c in plane]
        df = df.select(*keep, *[(new[c].alias(c) if c in new else F.col(c)) for c in names])
    above, equal = F.lit(0).cast("long"), F.lit(-1).cast("long")
    half_of = len(features) // 2
    for p in reversed(range(len(planes))):
        bit = F.col(planes[p][0]) if planes[p] else F.lit(0).cast("long")
        if half_of >> p & 1:
            equal = equal.bitwiseAND(bit)
        else:
            above = above.bitwiseOR(equal.bitwiseAND(bit))
            equal = equal.bitwiseAND(F.bitwise_not(bit))
    return df.select(*keep, above.alias("f"))


def _blocks(f: Column, radius: int) -> Column:
    """The keys of a fingerprint's blocks: block number and bits."""
    count = radius + 1
    edges = [64 * i // count for i in range(count + 1)]
    keys = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        bits = F.shiftrightunsigned(f, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys.append(F.xxhash64(F.lit(i), bits) if high - low > 48 else bits * count + i)
    return F.array(*keys)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: tuple[int, int] = SIMILARITY,
    radius: int = RADIUS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, item_id, similarity, first_word`` for each item found in a document.

    A row is the item's most similar window in that document (of equal ones the
    first); rows that repeat ids count as one document or item. Items without
    words are in no document. Null ids are kept as such. The index is
    broadcast; one larger than ``broadcast_bytes`` is cut into parts that fit
    and the documents are read once per part. Items of fewer than five words
    must occur as they are. Other columns are not read.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("h")).where("size(h) > 0")
    items = written(
        items.select(
            F.monotonically_increasing_id().alias("item_no"), "item_id", F.col("h").alias("item_h"),
            F.size("h").alias("words"),
        ),
        "items",
    )
    found = []
    above = 1 << 31
    for least, size, step in WINDOW_SIZES:
        of_size = items.where((F.col("words") >= least) & (F.col("words") < above))
        above = least
        index = written(_index(of_size, size, radius), "index")
        parts = -(-index.count() * INDEX_ROW_BYTES // broadcast_bytes)
        for part in range(parts):
            own = index.where(F.pmod(F.xxhash64("item_no"), F.lit(parts)) == part)
            found.append(written(_candidates(docs, own, size, step, radius), "candidates"))
    if not found:
        return _nothing(docs, benchmark)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    pairs = written(_pairs(items, every), "pairs")
    measured = _measured(docs, items, pairs, similarity, broadcast_bytes)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("first"))).alias("best")
    return measured.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"),
        (-F.col("best.first")).alias("first_word"),
    )


def _nothing(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    kinds = [(df.schema[c].dataType.simpleString(), c) for df, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    columns = ", ".join(f"{c} {kind}" for kind, c in kinds)
    return docs.sparkSession.createDataFrame([], f"{columns}, similarity double, first_word int")


def _index(items: DataFrame, size: int, radius: int) -> DataFrame:
    """Every window of the items, once for each block of its fingerprint."""
    windows = _windows(items.select("item_no", F.col("item_h").alias("h")), size, 1)
    return windows.select("item_no", F.col("f").alias("item_f")).distinct().select(
        "item_no", "item_f", F.explode(_blocks(F.col("item_f"), radius)).alias("block")
    )


def _hashed(docs: DataFrame) -> DataFrame:
    """``doc_id``, the words' hashes ``h`` and ``text_hash``, which tells rows of one id apart."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("h")
    )


def _candidates(docs: DataFrame, index: DataFrame, size: int, step: int, radius: int) -> DataFrame:
    """Per text and item where the first and the last window within the radius begin."""
    windows = _windows(_hashed(docs), size, step).select("doc_id", "text_hash", "start", "f")
    looked = windows.withColumn("block", F.explode(_blocks(F.col("f"), radius)))
    near = looked.join(F.broadcast(index), "block").where(
        F.bit_count(F.col("f").bitwiseXOR(F.col("item_f"))) <= radius
    )
    return near.groupBy("doc_id", "text_hash", "item_no").agg(
        F.min("start").alias("first_hit"), F.max("start").alias("last_hit")
    )


def _pairs(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates numbered, with the words where windows around their hits begin and end."""
    return candidates.join(items.select("item_no", "item_id", "words"), "item_no").select(
        F.monotonically_increasing_id().alias("pair_no"), "doc_id", "text_hash", "item_no", "item_id", "words",
        F.greatest(F.col("first_hit") - F.col("words"), F.lit(0)).alias("low"),
        (F.col("last_hit") + F.col("words")).alias("high"),
    )


def _shingles(rows: DataFrame, k: int, low: Column, high: Column) -> DataFrame:
    """A row per shingle of ``k`` words in ``h`` that begins in ``low`` to ``high``: ``at`` and ``x``."""
    kept = [c for c in rows.columns if c != "h"]
    high = F.least(high, F.size("h") - k)
    starts = F.when(high >= low, F.sequence(low, F.greatest(high, low)))
    return rows.withColumn("at", F.explode(starts)).select(
        *kept, "at", F.xxhash64(*[F.get("h", F.col("at") + j) for j in range(k)]).alias("x")
    )


def _measured(
    docs: DataFrame, items: DataFrame, pairs: DataFrame, similarity: tuple[int, int],
    broadcast_bytes: int,
) -> DataFrame:
    """The windows that are similar enough, where a run of alike ones begins or ends."""
    top, bottom = similarity
    few = keep_only(docs.select("doc_id", "text"), pairs, "doc_id", limit=broadcast_bytes)
    sought = pairs.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    rows = _hashed(few)
    near = rows.join(
        sought, rows["doc_id"].eqNullSafe(sought["__id"]) & (rows["text_hash"] == sought["__hash"])
    ).select("h", "pair_no", "item_no", "words", "low", "high")
    short = min(SHINGLE, items.agg(F.min("words")).head()[0] or SHINGLE)
    parts = []
    for k in range(short, SHINGLE + 1):
        of_k = F.col("words") == k if k < SHINGLE else F.col("words") >= SHINGLE
        own = items.where(of_k).select("item_no", F.col("item_h").alias("h"))
        own = _shingles(own, k, F.lit(0), F.size("h")).groupBy("item_no", "x").agg(
            F.count(F.lit(1)).cast("int").alias("times")
        )
        own = written(own, "shingles")
        if own.count() * INDEX_ROW_BYTES <= broadcast_bytes:
            own = F.broadcast(own)
        there = near.where(of_k).select(
            "h", "pair_no", "item_no", "low", "high",
            (F.col("words") - k + 1).alias("m"), (F.size("h") - k + 1).alias("last"),
        )
        shared = _shingles(there, k, F.col("low"), F.col("high")).join(own, ["item_no", "x"])
        parts.append(shared.select("pair_no", "x", "at", "times", "m", "last", "low"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Rows that repeat id and text find the same places. The steps after this stay within a task.
    places = every.groupBy("pair_no", "x", "times", "m", "last", "low").agg(
        F.sort_array(F.collect_set("at")).alias("ats")
    ).repartition("pair_no")

    # An occurrence counts where fewer than the item has of it follow in the window.
    def counted(at: Column, i: Column) -> Column:
        before = F.coalesce(F.get("ats", i - F.col("times")), F.lit(-1))
        return F.struct(F.greatest(at - F.col("m"), before, F.col("low") - 1).alias("after"), at.alias("upto"))

    runs = places.select("pair_no", "m", "last", F.explode(F.transform("ats", counted)).alias("run"))
    ends = F.explode(F.array(
        F.struct((F.col("run.after") + 1).alias("at"), F.lit(1).alias("more")),
        F.struct((F.col("run.upto") + 1).alias("at"), F.lit(-1).alias("more")),
    ))
    steps = runs.select("pair_no", "m", "last", ends.alias("end")).groupBy("pair_no", "m", "last", "end.at").agg(
        F.sum("end.more").alias("more")
    )
    along = Window.partitionBy("pair_no").orderBy("at")
    alike = steps.select(
        "pair_no", "m", "last", "at", F.lead("at").over(along).alias("next"),
        F.sum("more").over(along).alias("common"),
    ).where("common > 0")
    # Windows that the text's end cuts short are the more similar the later they begin.
    windows = alike.select(
        "pair_no", "m", "last", "common", F.explode(F.array("at", F.col("next") - 1)).alias("first_word")
    )
    union = F.col("m") + F.least("m", F.col("last") - F.col("first_word")) - F.col("common")
    enough = windows.where(F.col("common") * bottom >= union * top).select(
        "pair_no", "first_word", (F.col("common") / union).alias("similarity")
    )
    return enough.join(pairs.select("pair_no", "doc_id", "item_id"), "pair_no").drop("pair_no")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    leaks = written(find_leaks(docs, benchmark), "leaks")
    return keep_only(docs, leaks, "doc_id", "left_anti")
