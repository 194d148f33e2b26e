"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest hashes of a document's five-word shingles. Two
sketches merge into that of the union, whichever parts they come from, and
estimate resemblance, containment and the number of distinct shingles. A sketch
of fewer than ``k`` hashes is the whole set, and its estimates are exact.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.wordhash import shingle_sets

SIZE = 128
# The document order is cut into this many ranges per shuffle partition.
RANGES_PER_PARTITION = 4


def sketch(hashes: np.ndarray, k: int = SIZE) -> np.ndarray:
    """The ``k`` smallest distinct hashes, sorted."""
    return np.unique(hashes)[:k]


def merge(parts: Iterable[np.ndarray], k: int = SIZE) -> np.ndarray:
    """The sketch of the union of the sets behind ``parts``."""
    parts = list(parts)
    return sketch(np.concatenate(parts), k) if parts else np.zeros(0, np.uint64)


def distinct(s: np.ndarray, k: int = SIZE) -> float:
    """How many distinct shingles the set has; exact below ``k``."""
    if len(s) < k:
        return float(len(s))
    return (k - 1) / (float(s[k - 1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Jaccard similarity: of the union's ``k`` smallest, how many are in both. 1 for empty sets."""
    union = merge([a, b], k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Which part of ``a``'s set is in ``b``'s: of those both sketches cover. 1 if ``a`` is empty."""
    if not len(a):
        return 1.0
    limit = min([s[k - 1] for s in (a, b) if len(s) >= k], default=None)
    mine = a if limit is None else a[a <= limit]
    return float(np.isin(mine, b, assume_unique=True).mean()) if len(mine) else 0.0


def encode(s: np.ndarray) -> str:
    """A sketch as text: base64 of its big-endian hashes, in order."""
    return base64.b64encode(s.astype(">u8").tobytes()).decode("ascii")


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def with_next_text(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, text, next_text`` for every row: the text that follows by descending id.

    The last document is followed by the first. Null texts count as empty; rows
    of equal ids follow one another by their text, and null ids come last.

    Ids are cut into ranges at sampled quantiles, which only decides who works
    on what. The highest id of each range also goes, as an extra row, to the
    range above, whose last document it follows; so neighbours meet in one
    range and a text is shuffled once. The range of null ids is the lowest.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if ranges is None:
        ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = [i / ranges for i in range(1, ranges)]
    cuts, top = rows.agg(F.percentile_approx("doc_id", asked, 20 * ranges), F.max("doc_id")).head()
    bounds = np.unique(np.array([*(cuts or []), *([] if top is None else [top])], np.int64))

    @F.pandas_udf("range int, highest boolean")
    def place(ids: pd.Series) -> pd.DataFrame:
        known = ids.notna().to_numpy()
        of = np.zeros(len(ids), np.int32)
        highest = np.zeros(len(ids), bool)
        values = ids.dropna().astype(np.int64).to_numpy()
        of[known] = np.searchsorted(bounds, values)
        highest[known] = bounds[of[known]] == values
        return pd.DataFrame({"range": of, "highest": highest})

    above = (F.col("at.range") + 1) % F.lit(max(1, len(bounds)))
    copies = F.when(F.col("at.highest"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = (
        rows.withColumn("at", place("doc_id"))
        .withColumn("extra", F.explode(copies))
        .select("doc_id", "text", "extra", F.when(F.col("extra") == 0, F.col("at.range")).otherwise(above).alias("range"))
    )
    order = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    # Only where all ids are null has the one range no extra row.
    following = F.coalesce(F.lead("text").over(order), F.first("text").over(order))
    return placed.withColumn("next_text", following).where("extra = 0").select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of the next one's start."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half)
    )


SCHEMA = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, shingles double, edited_in_text double"
)


def fingerprints(docs: DataFrame, k: int = SIZE) -> DataFrame:
    """Fingerprints of every row's text, of its edited text and how alike they are.

    ``n_chars`` (code points), ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` (encoded sketches), ``near_edited`` and ``near_next``
    (resemblance to the edited and to the next document's text), ``shingles``
    (distinct ones) and ``edited_in_text`` (containment). Null texts count as
    empty; the sketch of a text without words is empty, and two empty ones have
    resemblance 1. Equal texts have equal fingerprints. An empty table gives no
    rows. Other columns are not read.
    """
    paired = with_next_text(docs)
    change = edited(F.col("text"), F.col("next_text"))
    rows = paired.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(change, 256).alias("edited_sha256"),
        "text", change.alias("edited"), "next_text",
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                own, new, after = (
                    [s[:k] for s in shingle_sets(batch.column(c).to_pylist())] for c in (3, 4, 5)
                )
                measures = (
                    [resemblance(a, b, k) for a, b in zip(own, new)],
                    [resemblance(a, b, k) for a, b in zip(own, after)],
                    [distinct(s, k) for s in own],
                    [containment(b, a, k) for a, b in zip(own, new)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:3],
                        pa.array([encode(s) for s in own], pa.string()),
                        pa.array([encode(s) for s in new], pa.string()),
                        *[pa.array(values, pa.float64()) for values in measures],
                    ],
                    names=schema.names,
                )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(SCHEMA).fields]
    )
    return rows.mapInArrow(made, schema)
