"""Token counts that follow edits without encoding whole documents again.

A document is cut into segments at boundaries between pre-tokens, and a binary
tree holds the tokens and characters below each node. An edit descends by
characters to the segments it touches, encodes these anew together with one
segment on either side, whose far ends no edit within can move, and updates
the sums on the paths to the root.

Segments end where the tokenizer starts a new pre-token whatever stands further
away: before white space that follows a visible character, before the last white
space in front of one, and where letters, digits and punctuation meet, but for
apostrophes, which may join letters. It never merges across such a place, so a
document's count is the sum of its segments' counts, exactly. Only one unbroken
run of letters, or of white space, is a segment however long it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEGMENT_CHARS = 512

# Letters and punctuation that every version of the tables classes alike.
_LETTER, _MARK = "A-Za-z\u4e00-\u9fa5", r"!-&(-/:-@\[-`{-~、。，！？；：「」（）"
_BOUNDARY = re.compile(
    rf"(?<=\S)(?=[ \n\r\t])|(?<=[ \n\r\t])(?=[ \n\r\t]\S)|(?<=[0-9{_LETTER}])(?=[{_MARK}'])"
    rf"|(?<=[{_MARK}])(?=[0-9{_LETTER}])|(?<=[0-9])(?=[{_LETTER}])|(?<=[{_LETTER}])(?=[0-9])"
)
# Runs of white space on which the pattern itself would overflow its stack.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")

Encode = Callable[[str], Sequence[int]]


def encoder(ranks: str = RANKS) -> Encode:
    """The tokenizer whose vocabulary is at ``ranks``.

    A long run of white space is cut as the pattern cuts it, into all but the
    last character and that with what follows, and encoded without the pattern.
    """
    import tiktoken

    with open(ranks, "rb") as lines:
        vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    made = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})

    def encode(text: str) -> Sequence[int]:
        ids: list[int] = []
        at = 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += made.encode_ordinary(text[at : run.start()])
            ids += made._encode_single_piece(text[run.start() : end])
            at = end
        return ids + made.encode_ordinary(text[at:]) if at else made.encode_ordinary(text)

    return encode


def segments(text: str, chars: int = SEGMENT_CHARS) -> list[str]:
    """``text`` cut at pre-token boundaries into pieces of ``chars`` or a little more."""
    pieces, at = [], 0
    while found := _BOUNDARY.search(text, at + chars):
        pieces.append(text[at : found.start()])
        at = found.start()
    return [*pieces, text[at:]]


class TokenTree:
    """Tokens of a document by segment, with sums over a binary tree."""

    def __init__(self, text: str, encode: Encode, chars: int = SEGMENT_CHARS) -> None:
        self.encode, self.chars = encode, chars
        self.encoded_chars = 0
        leaves = segments(text, chars)
        self._grow(leaves, [self._encoded(leaf) for leaf in leaves])

    def _grow(self, leaves: list[str], counts: list[int]) -> None:
        """The tree over ``leaves``, whose tokens are known."""
        self.leaves = leaves
        self.size = 1 << (len(leaves) - 1).bit_length()
        self.tokens = [0] * (2 * self.size)
        self.length = [0] * (2 * self.size)
        self.tokens[self.size : self.size + len(leaves)] = counts
        self.length[self.size : self.size + len(leaves)] = map(len, leaves)
        for node in range(self.size - 1, 0, -1):
            self._add_up(node)

    @property
    def count(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _encoded(self, leaf: str) -> int:
        self.encoded_chars += len(leaf)
        return len(self.encode(leaf)) if leaf else 0

    def _measure(self, i: int, leaf: str) -> None:
        self.leaves[i] = leaf
        self.length[self.size + i] = len(leaf)
        self.tokens[self.size + i] = self._encoded(leaf)

    def _add_up(self, node: int) -> None:
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.length[node] = self.length[2 * node] + self.length[2 * node + 1]

    def _find(self, at: int) -> tuple[int, int]:
        """The segment that holds character ``at`` (or the last), and where that starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + self.length[node] and self.length[node + 1]:
                start += self.length[node]
                node += 1
        return node - self.size, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` by ``new``."""
        low, begin = self._find(start)
        high, _ = self._find(max(start, end - 1))
        # Context: the next segments that are long enough to fix their far ends.
        left = low
        while left > 0 and (left == low or len(self.leaves[left]) < 2):
            left -= 1
        right = high
        while right < len(self.leaves) - 1 and (right == high or len(self.leaves[right]) < 2):
            right += 1
        begin -= sum(len(leaf) for leaf in self.leaves[left:low])
        region = "".join(self.leaves[left : right + 1])
        region = region[: start - begin] + new + region[end - begin :]
        pieces = segments(region, self.chars)
        places = right - left + 1
        if len(pieces) > places + 4:
            # A large insertion gets leaves of its own; the others keep their counts.
            counts = self.tokens[self.size : self.size + len(self.leaves)]
            own = [self._encoded(piece) for piece in pieces]
            self._grow(
                self.leaves[:left] + pieces + self.leaves[right + 1 :], counts[:left] + own + counts[right + 1 :]
            )
            return
        if len(pieces) > places:
            pieces = [*pieces[: places - 1], "".join(pieces[places - 1 :])]
        pieces += [""] * (places - len(pieces))
        nodes = set()
        for i, piece in enumerate(pieces, left):
            if piece != self.leaves[i]:
                self._measure(i, piece)
                nodes.add((self.size + i) // 2)
        while nodes and 0 not in nodes:
            for node in nodes:
                self._add_up(node)
            nodes = {node // 2 for node in nodes}


Edit = tuple[int, int, str]


def sample_edits(text: str) -> list[Edit]:
    """Three edits as an editor would make them: an insertion, a deletion and an appended word.

    Positions refer to the text as the edits before have left it.
    """
    n = len(text)
    inserted = " (edited) "
    middle = n // 2 + len(inserted)
    dropped = min(10, n - n // 2)
    return [
        (n // 4, n // 4, inserted),
        (middle, middle + dropped, ""),
        (n + len(inserted) - dropped, n + len(inserted) - dropped, " end."),
    ]


def count_tokens(
    docs: DataFrame, edits: Callable[[str], list[Edit]] = sample_edits, ranks: str = RANKS,
    chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """``doc_id, n_chars, tokens, edited_chars, edited_tokens, segments, encoded_chars`` per row.

    ``tokens`` counts the whole text; ``edited_tokens`` the text after
    ``edits``, for which ``encoded_chars`` characters were encoded again. Null
    texts count as empty. Repeated rows are counted alike; an empty table gives
    no rows. Other columns are not read.
    """
    names = ("n_chars", "tokens", "edited_chars", "edited_tokens", "segments", "encoded_chars")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            *[T.StructField(c, T.LongType()) for c in names],
        ]
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                tree = TokenTree(text, encode, chars)
                before, tree.encoded_chars = tree.count, 0
                for start, end, new in edits(text):
                    tree.edit(start, end, new)
                rows.append(
                    (len(text), before, tree.length[1], tree.count, len(tree.leaves), tree.encoded_chars)
                )
            columns = [pa.array(values, pa.int64()) for values in zip(*rows)] if rows else [
                pa.array([], pa.int64()) for _ in names
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(counted, schema)
