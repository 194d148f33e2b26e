"""Language identification by compression.

Each language has a dictionary of raw text. A document is compressed with every
dictionary, in chunks so that the dictionary counts throughout, and belongs to
the language whose total is smallest. How much smaller than the runner-up's it
is gives the score; below a margin the answer is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.mixing import draw

UNDETERMINED = "und"
# A dictionary is made of so many bytes at most, from excerpts of so many
# characters (more where documents are few) out of the middle of documents
# drawn by a seeded hash.
DICTIONARY_BYTES = 256 * 1024
EXCERPT_CHARS = 200
CHUNK_BYTES = 1024
LEVEL = 9
# Every chunk is led in by the end of the dictionary, which costs a few bytes.
# Without it the compressor stores short texts as they are, in any language.
LEAD_BYTES = 256
SEED = 11
# The relative margin under which an answer is marked as rejected.
MARGIN = 0.01


def learn(labelled: DataFrame, seed: int = SEED) -> dict[str, bytes]:
    """A dictionary for each value of ``lang`` in ``labelled`` (``doc_id, text, lang``).

    Only the bounded excerpts of the drawn documents reach the driver; null
    languages and texts are left out.
    """
    known = labelled.where("lang is not null and length(text) > 0").select("doc_id", "text", "lang")
    wanted = 1.5 * DICTIONARY_BYTES
    shares, chars = {}, {}
    for r in known.groupBy("lang").count().collect():
        chars[r["lang"]] = max(EXCERPT_CHARS, int(wanted / r["count"]))
        shares[r["lang"]] = min(1.0, wanted / EXCERPT_CHARS / r["count"])
    if not shares:
        return {}
    share, most = (
        F.create_map(*[F.lit(x) for pair in given.items() for x in pair])[F.col("lang")]
        for given in (shares, chars)
    )
    start = F.greatest(F.lit(1), F.floor((F.char_length("text") - most) / 2).cast("int"))
    drawn = known.withColumn("at", draw(seed, "doc_id", "text")).where(F.col("at") < share)
    rows = drawn.select("lang", "at", F.substring("text", start, most).alias("excerpt"))
    texts: dict[str, list[str]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["at"], r["excerpt"])):
        texts.setdefault(r["lang"], []).append(r["excerpt"])
    return {lang: "\n".join(t).encode("utf-8", "surrogatepass")[-DICTIONARY_BYTES:] for lang, t in texts.items()}


class Classifier:
    """Compressors with one dictionary each."""

    def __init__(self, dictionaries: Mapping[str, bytes]) -> None:
        self.langs = sorted(dictionaries)
        self.compressors = []
        self.leads = [dictionaries[lang][-LEAD_BYTES:] + b" " for lang in self.langs]
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            data.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
                    write_dict_id=False,
                )
            )

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of the whole text with each dictionary."""
        data = text.encode("utf-8", "surrogatepass")
        chunks = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        return [
            sum(len(c.compress(lead + chunk)) for chunk in chunks)
            for c, lead in zip(self.compressors, self.leads)
        ]

    def classify(self, text: str | None) -> tuple[str, float]:
        """The language, and by how large a part its size is below the next one's."""
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        ranked = sorted(zip(self.sizes(text), self.langs))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        return ranked[0][1], 1.0 - ranked[0][0] / ranked[1][0]


def identify(docs: DataFrame, dictionaries: Mapping[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``.

    ``lang_pred`` is a language of ``dictionaries``, of equal ones the first in
    order; ``und`` for a text that is null or has no letter, and for all if
    there are no dictionaries. Answers whose score is below ``margin`` are
    marked as rejected. Only texts are judged. An empty table gives no rows.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    given = dict(dictionaries)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(given)
        for batch in batches:
            found = [model.classify(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                    pa.array([score < margin for _, score in found], pa.bool_()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(judged, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: its id's CRC-32 modulo 4 is 2. Null for null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
