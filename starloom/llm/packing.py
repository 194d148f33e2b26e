"""Documents packed into training sequences by reciprocal-capacity classes.

A document is tokenized, what fills whole sequences is cut off, and the rest
falls into class i if i of its length fit a sequence but not i + 1. A bin of
class i takes exactly i documents of it, whatever they are, so no bin is ever
searched for: every worker keeps one open bin a class and works alone.

What a full bin leaves free is filled from a stream of the smallest documents,
cut where the bin ends; if there are too few of these, the next documents join
that stream whatever their class. So only about one document a sequence is cut,
and no sequence is padded. At the end a worker's open bins are poured into the
stream; its last tokens become sequences whose lengths are powers of two, which
need no padding either.
"""

from __future__ import annotations

import json
import os
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.shared import pieces_of

VOCABULARY = "word_bpe_49k.json"
END = 2
CAPACITY = 4096
# Documents shorter than this part of a sequence are the stream that fills gaps.
CLASSES = 16
# Bins that wait for it at most, and sequences that it holds at most.
WAITING = 32
TOKEN = 4
# Pre-tokens and words remembered with their ids, and UTF-8 bytes of the longest of them.
REMEMBERED = 600_000
LONGEST = 64
# Pre-tokens encoded by one call.
CALL = 4096
# UTF-8 bytes of a text, and of several, that are split together.
PIECE = 1 << 20
GROUP = 16 << 20
# Fixed value: the pre-token pattern that belongs to the vocabulary; texts are lower-cased before.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same over characters that every version of the Unicode tables classes and lower-cases alike
# and that nothing composes with: visible ASCII, letters of Latin-1 and Chinese characters.
_SMALL = "a-z\u00df-\u00f6\u00f8-\u00ff\u4e00-\u9fa5"
_LARGE = "A-Z\u00c0-\u00d6\u00d8-\u00de"
_RUN = rf"[{_SMALL}]+|'(?:[stmd]|re|ve|ll)|[!-/:-@\[-`{{-~]+|[0-9]"
# Words with any other character, or what may be a special token, are left to the tokenizer.
_OTHER = rf"[^\t-\r -~{_LARGE}{_SMALL}]|<\|"
ROWS = 8192
# Rows of a batch that become Python values together.
SLICE = 64


class Words:
    """Ids of words as little-endian 32-bit numbers, encoded when first met.

    Nothing is merged across pre-tokens, so the ids of a text are those of its
    words in order. Arrow splits several texts at ASCII white space, numbers their
    distinct words and looks these up. Unknown plain words are split into pre-tokens
    here and encoded together, and their ids told apart by the word ends that the
    vocabulary marks. A word with other characters is encoded as it is. A
    vocabulary that splits in another way encodes whole texts.

    Pre-tokens and such words stay known; at ``REMEMBERED`` of them all are forgotten.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from public_tokenizers import path
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path(vocabulary))
        self.known = {}
        with open(path(vocabulary), encoding="utf-8") as file:
            made = json.load(file)
        steps = [step["type"] for step in (made["normalizer"] or {}).get("normalizers", [])]
        splits = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = made["model"].get("end_of_word_suffix")
        self.splits = (
            steps == ["NFC", "Replace", "Lowercase"]
            and splits[0].get("pattern") == {"Regex": PATTERN}
            and suffix == "</w>"
        )
        if self.splits:
            known = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(known.values()) + 1, bool)
            self.ends[[number for token, number in known.items() if token.endswith(suffix)]] = True
            # For what is lower-cased and split already.
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )

    @property
    def known(self) -> dict[str, bytes]:
        return dict(zip(self.words.to_pylist(), self.ids.to_pylist()))

    @known.setter
    def known(self, ids: dict[str, bytes]) -> None:
        self.words = pa.array(list(ids), pa.large_string())
        self.ids = pa.array(list(ids.values()), pa.large_binary())

    def encoded(self, text: str) -> bytes:
        return self.encoded_all([text.encode("utf-8")])[0]

    def encoded_all(self, texts: Sequence[bytes]) -> list[bytes]:
        """The ids of each of several texts in UTF-8."""
        if not self.splits:
            return [_ids(self.tokenizer, text.decode("utf-8")).tobytes() for text in texts]
        parts: list[list[bytes]] = [[] for _ in texts]
        numbers: list[int] = []
        pieces: list[bytes] = []
        size = 0

        def encode() -> None:
            for number, ids in zip(numbers, self._encoded(pieces)):
                parts[number].append(ids)

        for number, text in enumerate(texts):
            for piece in pieces_of(text, PIECE):
                numbers.append(number)
                pieces.append(piece)
                size += len(piece)
                if size >= GROUP:
                    encode()
                    numbers, pieces, size = [], [], 0
        if pieces:
            encode()
        return [held[0] if len(held) == 1 else b"".join(held) for held in parts]

    def _encoded(self, pieces: Sequence[bytes]) -> list[bytes]:
        # Other texts keep their case: it may tell a special token, or what is composed.
        plain = [piece.lower() if piece.isascii() and b"<|" not in piece else piece for piece in pieces]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        words = split.flatten().dictionary_encode()
        held = self._found(words.dictionary, self._learned).take(words.indices)
        offsets = np.frombuffer(held.buffers()[1], "<i8")[split.offsets.to_numpy()].tolist()
        data = memoryview(held.buffers()[2] or b"")
        return [data[start:end].tobytes() for start, end in zip(offsets, offsets[1:])]

    def _found(self, words: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of distinct words, known or learned."""
        at = pc.index_in(words, value_set=self.words)
        new = at.is_null()
        unknown, held = words.filter(new), self.ids
        learned = learn(unknown)
        rows = at.fill_null(0).to_numpy().astype("i8")
        rows[new.to_numpy(zero_copy_only=False)] = len(held) + np.arange(len(unknown))
        return pa.concat_arrays([held, learned]).take(pa.array(rows))

    def _remember(self, words: pa.Array, ids: pa.Array) -> None:
        if len(self.words) + len(words) > REMEMBERED:
            self.known = {}
        short = pc.less_equal(pc.binary_length(words), LONGEST)
        self.words = pa.concat_arrays([self.words, words.filter(short)])
        self.ids = pa.concat_arrays([self.ids, ids.filter(short)])

    def _learned(self, words: pa.Array) -> pa.Array:
        """The ids of words without ASCII white space."""
        odd = pc.match_substring_regex(words, _OTHER)
        plain = pc.utf8_lower(words.filter(pc.invert(odd)))
        # A space ends each pre-token.
        runs = pc.split_pattern(pc.replace_substring_regex(plain, _RUN, r"\0 "), " ")
        distinct = runs.flatten().dictionary_encode()
        held = self._found(distinct.dictionary, self._merged).take(distinct.indices)
        offsets = np.frombuffer(held.buffers()[1], "<i8")[runs.offsets.to_numpy()]
        joined = _binary(offsets, held.buffers()[2])
        other = odd.to_numpy(zero_copy_only=False)
        rows = np.empty(len(words), "i8")
        rows[~other] = np.arange(len(plain))
        rows[other] = np.arange(len(plain), len(words))
        others = words.filter(odd)
        whole = self._whole(others)
        self._remember(others, whole)
        return pa.concat_arrays([joined, whole]).take(pa.array(rows))

    def _merged(self, runs: pa.Array) -> pa.Array:
        """The ids of plain pre-tokens, or none of an empty one, by few calls of the tokenizer."""
        parts = [pa.array([], pa.large_binary())]
        for at in range(0, len(runs), CALL):
            part = runs[at : at + CALL]
            ids = _ids(self.merges, " ".join(part.to_pylist()))
            ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
            last = np.concatenate([[0], np.cumsum(pc.binary_length(part).to_numpy() > 0)])
            told = last[-1] == len(ends) - 1
            parts.append(_binary(ends[last] * TOKEN, pa.py_buffer(ids)) if told else self._whole(part))
        learned = pa.concat_arrays(parts)
        self._remember(runs, learned)
        return learned

    def _whole(self, words: pa.Array) -> pa.Array:
        encoded = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        return pa.array([np.asarray(e.ids, "<u4").tobytes() for e in encoded], pa.large_binary())


@lru_cache(maxsize=1)
def _words(vocabulary: str) -> Words:
    """One for all tasks that a worker runs: it loads the vocabulary and learns words once."""
    return Words(vocabulary)


def _binary(offsets: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    offsets = pa.py_buffer(offsets.astype("<i8"))
    return pa.Array.from_buffers(pa.large_binary(), offsets.size // 8 - 1, [None, offsets, data])


def _ids(tokenizer, text: str) -> np.ndarray:
    return np.asarray(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


Piece = tuple[int, int, memoryview]


class Packer:
    """One worker's bins. ``done`` takes finished sequences as (document, start, tokens)."""

    def __init__(self, capacity: int = CAPACITY, classes: int = CLASSES) -> None:
        self.capacity, self.classes = capacity, classes
        self.open: dict[int, list[Piece]] = {}
        self.gaps: deque[tuple[int, list[Piece]]] = deque()
        self.stream: deque[Piece] = deque()
        self.streamed = 0
        self.done: list[list[Piece]] = []

    def add(self, document: int, tokens: bytes) -> None:
        view, n = memoryview(tokens), len(tokens) // TOKEN
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            self.done.append([(document, start, view[start * TOKEN : (start + self.capacity) * TOKEN])])
        if whole < n:
            self._place((document, whole, view[whole * TOKEN :]))

    def _place(self, piece: Piece) -> None:
        held = self.capacity // (len(piece[2]) // TOKEN)
        if held > self.classes or len(self.gaps) >= WAITING:
            self._pour(piece)
            if self.streamed >= WAITING * self.capacity:
                self.done.append(self._taken(self.capacity))
            return
        bin_ = self.open.setdefault(held, [])
        bin_.append(piece)
        if len(bin_) == held:
            free = self.capacity - sum(len(p[2]) for p in self.open.pop(held)) // TOKEN
            self.gaps.append((free, bin_))
            self._fill()

    def _pour(self, piece: Piece) -> None:
        self.stream.append(piece)
        self.streamed += len(piece[2]) // TOKEN
        self._fill()

    def _fill(self) -> None:
        while self.gaps and self.gaps[0][0] <= self.streamed:
            free, bin_ = self.gaps.popleft()
            self.done.append(bin_ + self._taken(free))

    def _taken(self, tokens: int) -> list[Piece]:
        """The first ``tokens`` of the stream; the last piece is cut."""
        self.streamed -= tokens
        out = []
        while tokens:
            document, start, view = self.stream.popleft()
            n = min(tokens, len(view) // TOKEN)
            out.append((document, start, view[: n * TOKEN]))
            if n * TOKEN < len(view):
                self.stream.appendleft((document, start + n, view[n * TOKEN :]))
            tokens -= n
        return out

    def finish(self) -> None:
        for bin_ in self.open.values():
            for piece in bin_:
                self._pour(piece)
        self.open = {}
        while self.gaps:
            for piece in self.gaps.pop()[1]:
                self._pour(piece)
        while self.streamed:
            self.done.append(self._taken(min(self.capacity, 1 << (self.streamed.bit_length() - 1))))


_LONGS = ("start", "length", "doc_tokens", "sequence_id", "offset")


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of a batch in order, about half of ``GROUP`` bytes of text at a time."""
    doc_ids, texts, size = [], [], 0
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        doc_ids += part.column(0).to_pylist()
        taken = [text or b"" for text in part.column(1).cast(pa.large_binary()).to_pylist()]
        texts += taken
        size += sum(map(len, taken))
        if size >= GROUP // 2:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def _packed(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, capacity: int, classes: int
) -> Iterator[pa.RecordBatch]:
    words, packer = _words(vocabulary), Packer(capacity, classes)
    last = np.asarray([end], "<u4").tobytes()
    first = TaskContext.get().partitionId() << 33
    # Documents by number: their id, their tokens and how many of these are not yet written.
    documents: dict[int, list] = {}
    number = sequences = 0
    types = [pa.null(), *[pa.int64()] * len(_LONGS), pa.binary()]

    def rows() -> pa.RecordBatch:
        nonlocal sequences
        columns: list[list] = [[] for _ in types]
        for sequence in packer.done:
            offset = 0
            for document, start, view in sequence:
                held = documents[document]
                n = len(view) // TOKEN
                for column, value in zip(
                    columns, (held[0], start, n, held[1], first + sequences, offset, view.tobytes())
                ):
                    column.append(value)
                offset += n
                held[2] -= n
                if not held[2]:
                    del documents[document]
            sequences += 1
        packer.done = []
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types)], names=["doc_id", *_LONGS, "tokens"]
        )

    for batch in batches:
        types[0] = batch.column(0).type
        for doc_ids, texts in _groups(batch):
            for doc_id, tokens in zip(doc_ids, words.encoded_all(texts)):
                tokens += last
                n = len(tokens) // TOKEN
                documents[number] = [doc_id, n, n]
                packer.add(number, tokens)
                number += 1
                if len(packer.done) >= ROWS // classes:
                    yield rows()
    packer.finish()
    if packer.done:
        yield rows()


def pack_documents(
    docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, capacity: int = CAPACITY,
    classes: int = CLASSES,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, tokens``: a row per piece.

    A piece is ``length`` tokens of a document from ``start`` on, little-endian
    32-bit numbers in ``tokens``, at ``offset`` of a sequence of at most
    ``capacity``. Each document ends in the token ``end``. Every sequence is full or its
    length is a power of two. ``vocabulary`` is a file of the public tokenizers or
    a path.

    Null and empty texts are the end token alone; rows that repeat an id, also
    null ones, are documents of their own. An empty table gives no rows. Other
    columns are not read. Sequences follow the partitions of ``docs`` and the
    order in them, so a table that shuffles should be written first.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(c, T.LongType()) for c in _LONGS]
        + [T.StructField("tokens", T.BinaryType())]
    )
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _packed(batches, vocabulary, end, capacity, classes), schema
    )
