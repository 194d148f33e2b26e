from __future__ import annotations

import base64
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import SCHEMA, awkward
from conftest import TESTDATA
from starloom.llm.queries import QUERIES
from starloom.llm.token_counts import PATTERN, RANKS, TokenTree, count_tokens, encoder, sample_edits, segments

ENCODE = encoder()
TEXT = st.text(alphabet="ab 1.'s\n\t  é\U0001f600\x1c日、_\r", max_size=200)


def edited(text, edits):
    for start, end, new in edits:
        text = text[:start] + new + text[end:]
    return text


@settings(deadline=None, max_examples=300)
@given(TEXT, st.lists(st.tuples(st.floats(0, 1), st.integers(0, 30), TEXT.map(lambda t: t[:12])), max_size=6))
def test_counts_after_edits_equal_those_of_the_whole_text(text, edits):
    encode = ENCODE
    tree = TokenTree(text, encode, 4)
    assert tree.count == len(encode(text))
    for place, size, new in edits:
        start = int(place * len(text))
        end = min(len(text), start + size)
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
        assert tree.text == text
        assert (tree.count, tree.length[1]) == (len(encode(text)), len(text))


def test_many_edits_of_one_document_stay_local():
    encode, rng = ENCODE, random.Random(1)
    text = " ".join(f"word{rng.randrange(999)}" for _ in range(20_000))
    tree = TokenTree(text, encode)
    tree.encoded_chars = 0
    for _ in range(50):
        start = rng.randrange(len(text))
        tree.edit(start, start + 3, "x y")
        text = text[:start] + "x y" + text[start + 3 :]
    assert tree.count == len(encode(text))
    assert tree.encoded_chars < len(text) * 0.8


@pytest.mark.parametrize("text", ["", "a", "no_boundary" * 400, "a b " * 500, "\n\n a  b\n"])
def test_segments_join_to_the_text_and_its_count(text):
    parts = segments(text, 8)
    assert "".join(parts) == text
    assert sum(len(ENCODE(p)) for p in parts) == len(ENCODE(text))


@pytest.mark.parametrize("run", [" ", "\n", " \t\n", "日本"])
def test_very_long_runs_are_counted(run):
    """Runs on which the pattern alone would overflow, against shorter ones that it encodes."""
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for before, after in (("", ""), ("x", ""), ("", "y"), ("x", " y"), ("x ", ".")):
        short = run * 2000
        direct = before + short + after
        assert list(ENCODE(direct)) == plain.encode_ordinary(direct)
    text = "a" + run * (5_000_000 // len(run)) + "b"
    tree = TokenTree(text, ENCODE)
    assert tree.count == len(ENCODE(text)) and tree.length[1] == len(text)


def test_edits_stay_local_without_spaces():
    rng = random.Random(2)
    text = "".join(rng.choice(["日本語", "中文", "、", "。", "abc", "12", "(", "x1;"]) for _ in range(400_000))[:700_000]
    tree = TokenTree(text, ENCODE)
    tree.encoded_chars = 0
    for start, end, new in sample_edits(text):
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
    assert tree.count == len(ENCODE(text)) and tree.encoded_chars < 0.05 * len(text)


def test_large_insertions_get_leaves_of_their_own():
    rng = random.Random(3)
    text, new = "short text", " ".join(f"w{rng.randrange(999)}" for _ in range(50_000))
    tree = TokenTree(text, ENCODE)
    tree.edit(5, 6, new)
    text = text[:5] + new + text[6:]
    tree.encoded_chars = 0
    for _ in range(20):
        at = rng.randrange(len(text))
        tree.edit(at, at, "z ")
        text = text[:at] + "z " + text[at:]
    assert tree.text == text and tree.count == len(ENCODE(text))
    assert tree.encoded_chars < len(text) / 2


def check(got, texts):
    encode = ENCODE
    for r, text in zip(got, texts):
        new = edited(text, sample_edits(text))
        assert (r.n_chars, r.tokens) == (len(text), len(encode(text)))
        assert (r.edited_chars, r.edited_tokens) == (len(new), len(encode(new)))


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).withColumn("tokens", F.lit("x")).coalesce(1)
    check(count_tokens(docs).collect(), [r[1] or "" for r in awkward()])
    assert count_tokens(docs.limit(0)).collect() == []


def test_registered_query(spark):
    folder = str(TESTDATA / "sf0.001")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op9_token_counts"](spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    check(got, [texts[r.doc_id] for r in got])
