from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import SCHEMA, awkward, row, sentence, shingles
from conftest import TESTDATA
from starloom.llm import minhash, wordhash
from starloom.llm.components import connected_components
from starloom.llm.queries import QUERIES


def components(rows):
    """Smallest reachable id per row, by comparing every pair."""
    sets = [shingles(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r[0])
    least = {k: min([i for i in v if i is not None], default=None) for k, v in ids.items()}
    return [(r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)]


def check(spark, rows, **options):
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(
        map(repr, components(rows))
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_awkward_rows(spark):
    check(spark, awkward())


def test_no_rows_and_no_pairs(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [row(1, "a b c d e f"), row(2, None)])


def varied(seed, groups, copies):
    """Copies of a text with runs of words replaced, so that many pairs are near the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = sentence(g + 50, rng.randint(20, 90)).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append(row(rng.randrange(10**9), " ".join(own)))
    return rows


def test_chains_near_the_threshold(spark):
    check(spark, varied(1, 12, 14))


def test_large_buckets_are_cut_and_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    check(spark, varied(2, 3, 40), large=5)


def test_links_of_near_misses_grow_in_proportion(spark, monkeypatch):
    """Members of a group nearly all just below the threshold to each other."""
    seen = {}
    real = minhash._links_across

    def counted(*args):
        found = real(*args)
        seen["rows"] = found.count()
        return found

    monkeypatch.setattr(minhash, "_links_across", counted)
    made = {}
    for n in (250, 500, 1000):
        rng, base, rows = random.Random(n), sentence(1, 300).split(), []
        for i in range(n):
            own = list(base)
            for at in rng.sample(range(300), 5):
                own[at] = f"n{rng.randrange(10**6)}"
            rows.append(row(i, " ".join(own)))
        if n == 250:
            check(spark, rows)
        else:
            minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
        made[n] = seen["rows"]
    # Links that join components, at most one a member and bucket; never pairs.
    assert made[250] and made[1000] <= 6 * made[250] and made[500] <= 3 * made[250]


def test_common_counts_in_narrow_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200), dtype=np.uint64)) for _ in range(40)]
    owners = np.repeat(np.arange(40), [len(s) for s in sets])
    few = np.arange(0, 40, 3)
    for cells in (40, 999, 1 << 20):
        monkeypatch.setattr(minhash, "CELLS", cells)
        got = minhash._common(np.concatenate(sets), owners, few, 40)
        expected = np.array([[len(np.intersect1d(sets[i], s)) for s in sets] for i in few])
        # A set's count with itself is not used, and lacks what no other set has.
        expected[np.arange(len(few)), few] = got[np.arange(len(few)), few]
        assert np.array_equal(got, expected)


def test_registered_query_against_every_pair(spark):
    sf_dir = str(TESTDATA / "sf0.001")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op3_minhash"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(components(rows))


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).withColumn("kept", F.lit("extra"))
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 9, 11, 12, 13, 14]
    assert ids.count(None) == 1


def test_pipeline_keeps_unlike_texts_that_share_an_id(spark):
    rows = [*awkward(), row(14, sentence(4, 29) + " changed"), row(14, sentence(1, 40)), row(3, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("root", F.lit("extra"))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = kept.collect()
    # Of the rows of 14 one text is a copy of 6, and two are near copies of each other.
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [1, 2, 3, 4, 6, 9, 11, 12, 13, 14, 14]
    own = {r.text for r in found if r.doc_id == 14}
    assert sentence(3, 30) in own and own & {sentence(4, 30), sentence(4, 29) + " changed"}


def test_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = wordhash.mix(pool[:240]), wordhash.mix(pool[60:])
        errors.append((minhash.signature(a) == minhash.signature(b)).mean() - 180 / 300)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < (0.6 * 0.4 / minhash.PERMUTATIONS) ** 0.5


@pytest.mark.parametrize("piece", [7, 64, 1 << 18])
def test_shingle_hashes_do_not_depend_on_pieces(monkeypatch, piece):
    texts = [r[1] for r in awkward()]
    expected = wordhash.shingle_sets(texts)
    monkeypatch.setattr(wordhash, "PIECE_BYTES", piece)
    got = wordhash.shingle_sets(texts)
    assert all(np.array_equal(a, b) for a, b in zip(got, expected))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    roots = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in roots} == (
        {(i, 0) for i in range(21)} | {(i, 100) for i in range(100, 130)} | {(i, 200) for i in range(200, 209)}
    )
    assert len(roots) == 60
    assert connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()
