from __future__ import annotations

import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import SCHEMA, awkward, row, sentence
from conftest import TESTDATA
from starloom.llm import packing
from starloom.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END]


def digest(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def check(rows, documents, capacity=packing.CAPACITY):
    """Every id of every document in one piece; sequences gapless, full or a power of two."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens, r.ids_crc32))
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total and length > 0
            total += length
        assert total <= capacity and (total == capacity or total & (total - 1) == 0)
    expected = defaultdict(list)
    for doc_id, text in documents:
        expected[doc_id].append(ids_of(text))
    assert set(pieces) == set(expected)
    for doc_id, texts in expected.items():
        left = sorted(pieces[doc_id])
        for ids in texts:
            # Documents that share an id are told apart by their digests.
            at = 0
            while at < len(ids):
                fitting = [p for p in left if p[0] == at and p[2] == len(ids) and digest(ids[at : at + p[1]]) == p[3]]
                assert fitting, (doc_id, at)
                left.remove(fitting[0])
                at += fitting[0][1]
            assert at == len(ids)
        assert not left


def with_digests(df):
    from pyspark.sql import functions as F

    return df.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens").collect()


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).selectExpr("*", "1 as start", "'x' as tokens")
    rows = with_digests(packing.pack_documents(docs))
    check(rows, [(r[0], r[1]) for r in awkward()])
    # Null and empty texts are the end token alone.
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}


def test_empty_table_and_text_ids(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([("a", "one two"), ("b", None)], "doc_id string, text string")
    rows = with_digests(packing.pack_documents(docs))
    check(rows, [("a", "one two"), ("b", None)])


def test_equal_rows_own_a_third(spark):
    rows = [row(i, sentence(1, 900)) for i in range(60)] + [row(100 + i, sentence(i, 5 + 13 * i)) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    packed = with_digests(packing.pack_documents(docs))
    check(packed, [(r[0], r[1]) for r in rows])
    # Few cuts: about one document a sequence.
    assert len(packed) <= len(rows) + 2 * len({r.sequence_id for r in packed})


def test_registered_query(spark):
    folder = str(TESTDATA / "sf0.001")
    documents = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op11_packing"](spark, folder).collect(), documents)


@pytest.mark.parametrize(
    "text",
    [
        " " * 3_000_000 + "end",
        "日本" * 20_000,
        "it's  Á café x\x1cy z <|endoftext|>\tb\x85c",
        "á ́b ΣΣ 1234567 !!??",
    ],
)
def test_words_encode_like_whole_texts(text):
    words = packing.Words(packing.VOCABULARY)
    ids = words.encoded(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == ids_of(text)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_alike(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = _WORDS.encoded(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == ids_of(text)[:-1]


_WORDS = packing.Words(packing.VOCABULARY)


@pytest.mark.parametrize("longest", [3, 64, 400, 5000])
def test_classes_fill_by_count(longest):
    """Full bins hold the count of their class, and little is held back."""
    draw = random.Random(longest)
    packer, total = packing.Packer(1024, 16), 0
    for i in range(3000):
        n = draw.randint(1, longest)
        packer.add(i, bytes(4 * n))
        total += n
        assert len(packer.gaps) <= packing.WAITING
        assert packer.streamed <= (packing.WAITING + 1) * packer.capacity
        for held, bin_ in packer.open.items():
            assert len(bin_) < held and all(held == 1024 // (len(p[2]) // 4) for p in bin_)
    packer.finish()
    sizes = [sum(len(p[2]) for p in s) // 4 for s in packer.done]
    assert sum(sizes) == total and all(n & (n - 1) == 0 for n in sizes)
    assert sum(n < 1024 for n in sizes) <= 10


HELD = packing.Words(packing.VOCABULARY)
PRETOKENS = [
    "don't", "DON''T", "it'S", "rock'n'roll's", "a1b22", "x<|endoftext|>y", "<|", "|>", "</w>", "w>", "café", "CAFÉÑ",
    "café", "İstanbul", "ΟΣ", "漢字abc", "한글", "a b", "a\u001cb", "×÷", "½²", "ßẞ", "ªµ", "!?'s--'ll", "e.g.", "\x00", "\x7f",
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PRETOKENS), st.text(max_size=6)), max_size=12), st.sampled_from([" ", "\n", "\t ", ""]))
def test_ids_are_those_of_whole_texts(words, space):
    text = space.join(words)
    HELD.known = {}
    for _ in range(2):
        assert list(struct.iter_unpack("<I", HELD.encoded(text))) == [(i,) for i in ids_of(text)[:-1]]


def test_long_words_and_other_vocabularies():
    held = packing.Words(packing.VOCABULARY)
    for text in ["x" * 5000 + " y", "!" * 3000, "9" * 500, "é" * 700_000 + " end"]:
        assert held.encoded(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])
    assert not any(len(word) > packing.LONGEST for word in held.known)
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = other.encode("It's  two\n\nlines", add_special_tokens=False).ids
    assert packing.Words("byte_bpe_50k.json").encoded("It's  two\n\nlines") == struct.pack(f"<{len(ids)}I", *ids)


def test_texts_learn_words_together(monkeypatch):
    """Words new to many texts are encoded by few calls, each once; a worker loads the vocabulary once."""
    words = packing.Words(packing.VOCABULARY)
    texts = [f"Word{chr(97 + i // 26)}{chr(97 + i % 26)}q, and the same: don't stop {i}" for i in range(500)]
    texts += ["", " \n ", "Ärger über die ß", "ЖИЗНЬ и жизнь", "x" * 200 + ".", "<|endoftext|>"]
    seen = []
    encode = packing._ids
    monkeypatch.setattr(packing, "_ids", lambda tokenizer, text: seen.append(text) or encode(tokenizer, text))
    found = words.encoded_all([text.encode("utf-8") for text in texts])
    assert [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in found] == [ids_of(t)[:-1] for t in texts]
    assert len(seen) <= 2 and sum(text.split().count("same") for text in seen) == 1
    assert packing._words(packing.VOCABULARY) is packing._words(packing.VOCABULARY)


def test_small_groups_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 300)
    monkeypatch.setattr(packing, "PIECE", 50)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    words = packing.Words(packing.VOCABULARY)
    texts = [sentence(i, 5 + 7 * i) for i in range(40)] + ["", "日本 語 " * 40, "x" * 400]
    found = words.encoded_all([text.encode("utf-8") for text in texts])
    assert [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in found] == [ids_of(t)[:-1] for t in texts]
