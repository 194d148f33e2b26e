from __future__ import annotations

import pytest

import corpus_pipeline
from conftest import TESTDATA
from starloom.llm.queries import ORACLE, QUERIES


def test_stages_in_order_and_what_they_return(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash near-dedup", "benchmark decontamination", "mixing", "sharding",
    ]
    folder = str(TESTDATA / "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    columns, before = docs.columns, set(texts)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, folder), "stage")
        rows = docs.collect()
        after = [r.doc_id for r in rows]
        assert len(set(after)) == len(after) and set(after) <= before
        assert all(r.text == texts[r.doc_id] for r in rows)
        if i < 4:
            assert docs.columns == columns and len(after) < len(before)
        else:
            assert set(after) == before and docs.columns == [*columns, "shard", "slot"]
        before = set(after)
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == before


@pytest.mark.parametrize("size", ["sf0.001"])
def test_an_empty_corpus_goes_through(spark, size):
    folder = str(TESTDATA / size)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), "stage")
    assert docs.collect() == []


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)
