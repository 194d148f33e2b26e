from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from cases import SCHEMA, awkward, row, sentence, shingles
from conftest import TESTDATA
from starloom.llm import sketch, wordhash
from starloom.llm.queries import QUERIES


def numbers(n, seed=1):
    return wordhash.mix(np.arange(n, dtype=np.uint64) + np.uint64(seed << 40))


def test_sketches_merge_like_their_sets():
    a, b = numbers(5000), numbers(3000, 2)
    whole = sketch.sketch(np.concatenate([a, b]))
    parts = [sketch.sketch(p) for p in np.array_split(np.concatenate([a, b, a]), 7)]
    assert np.array_equal(sketch.merge(parts), whole)
    assert np.array_equal(sketch.decode(sketch.encode(whole)), whole)
    assert len(sketch.merge([])) == 0


def test_estimates():
    pool = numbers(40_000)
    errors, inside, counts = [], [], []
    for at in range(0, 30_000, 1000):
        a, b = sketch.sketch(pool[at : at + 3000]), sketch.sketch(pool[at + 1000 : at + 4000])
        errors.append(sketch.resemblance(a, b) - 0.5)
        inside.append(sketch.containment(a, b) - 2 / 3)
        counts.append(sketch.distinct(a) / 3000 - 1)
    for values in (errors, inside, counts):
        assert abs(np.mean(values)) < 0.05 and np.abs(values).max() < 0.35
    small = sketch.sketch(pool[:30])
    assert sketch.distinct(small) == 30 and sketch.containment(small, sketch.sketch(pool[:60])) == 1
    empty = small[:0]
    assert sketch.resemblance(empty, empty) == 1 and sketch.resemblance(empty, small) == 0


def plain(rows):
    """The contract restated over sorted rows."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        sets = [shingles(t) for t in (text, new, after)]
        exact = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        sizes = [len(sets[0] | s) for s in sets[1:]]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), exact, sizes))
    return out


def check(got, rows):
    expected = plain(rows)
    assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == sorted(
        repr(e[:3]) for e in expected
    )
    by = {(e[0], e[2]): e for e in expected}
    for r in got:
        _, _, _, exact, sizes = by[(r.doc_id, r.edited_sha256)]
        for value, true, size in zip((r.near_edited, r.near_next), exact, sizes):
            assert abs(value - true) < (1e-9 if size <= sketch.SIZE else 0.25)
            assert 0 <= value <= 1


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).withColumn("range", F.lit(0))
    got = sketch.fingerprints(docs).collect()
    check(got, awkward())
    same = [r.fingerprint for r in got if r.doc_id in (6, 7)]
    assert len(same) == 3 and len(set(same)) == 1


def test_ranges_and_degenerate_tables(spark):
    rows = [row(i * i, sentence(i, 3 + i % 40)) for i in range(200)]
    paired = sketch.with_next_text(spark.createDataFrame(rows, SCHEMA), ranges=37).collect()
    order = sorted(rows, reverse=True)
    after = {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1])}
    assert {r.doc_id: r.next_text for r in paired} == after and len(paired) == 200
    for few in ([], [row(1, "a b")], [row(None, "x"), row(None, "y")], [row(3, "x"), row(3, "y"), row(3, None)]):
        check(sketch.fingerprints(spark.createDataFrame(few, SCHEMA)).collect(), few)


def test_registered_query(spark):
    folder = str(TESTDATA / "sf0.001")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op6_sketch"](spark, folder).collect(), rows)
