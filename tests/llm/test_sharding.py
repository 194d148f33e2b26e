from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cases import SCHEMA, awkward, row, sentence
from conftest import TESTDATA
from starloom.llm.queries import QUERIES
from starloom.llm.sharding import permutation, shard_records


def check_law(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_every_row_once_by_the_law(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).withColumn("slot", F.lit("old"))
    for bucket_bytes in (1, 1 << 20):
        rows = shard_records(docs, 4, bucket_bytes=bucket_bytes).collect()
        check_law(rows, 4)
        assert sorted(map(repr, [tuple(r)[:5] for r in rows])) == sorted(map(repr, awkward()))


def test_no_rows(spark):
    empty = shard_records(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]


def test_places_do_not_depend_on_the_partitioning(spark):
    docs = spark.createDataFrame([row(i, sentence(i % 7, 20)) for i in range(500)], SCHEMA)
    places = [
        sorted((r.doc_id, r.shard, r.slot) for r in shard_records(d, 6).collect())
        for d in (docs.coalesce(1), docs.repartition(7, "text"))
    ]
    assert places[0] == places[1]
    assert places[0] != sorted((r.doc_id, r.shard, r.slot) for r in shard_records(docs, 6, seed=8).collect())


def test_one_hot_text_spreads_over_shards(spark):
    docs = spark.createDataFrame([row(i, "same") for i in range(2000)], SCHEMA)
    rows = shard_records(docs, 10).collect()
    check_law(rows, 10)
    ids = np.array([r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))])
    assert abs(np.corrcoef(ids, np.arange(2000))[0, 1]) < 0.1


def test_permutations_are_uniform():
    counts = Counter(tuple(permutation(3, 1, seed)) for seed in range(6000))
    assert len(counts) == 6 and min(counts.values()) > 850
    assert permutation(0, 1).tolist() == [] and permutation(1, 1).tolist() == [0]


def test_registered_query(spark):
    folder = str(TESTDATA / "sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op2_sharding"](spark, folder).collect()
    check_law(rows, 40)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.law, r.grown_shard) == (len(data) + 16, "rows", None)
        assert r.text_crc32 == zlib.crc32(data)
