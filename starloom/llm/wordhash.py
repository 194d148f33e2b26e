"""Hashes of words and word shingles of many texts at once, in numpy.

Words are runs of anything but U+0009..U+000D and U+0020, with A-Z in lower
case. A word's hash is a polynomial over its bytes modulo 2**64, taken from
running sums so that no word becomes a Python object; a shingle's hash is one
over its words' mixed hashes. A text is worked through in pieces cut at white
space, so memory does not follow its length beyond eight bytes a word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

WORDS_PER_SHINGLE = 5
PIECE_BYTES = 1 << 18

_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_IS_WORD = ~np.isin(np.arange(256), list(_SPACES))
_BYTES = np.random.default_rng(20_011).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SHORT = 0xA0761D6478BD642F


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def powers(base: int) -> np.ndarray:
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                return np.cumprod(factors, dtype=np.uint64)

            self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        return self.up, self.down


_POWERS = _Powers()


def _pieces(data: bytes) -> list[bytes]:
    """``data`` cut at white space into pieces of about ``PIECE_BYTES``."""
    pieces, at = [], 0
    while len(data) - at > 2 * PIECE_BYTES:
        found = _SPACE.search(data, at + PIECE_BYTES)
        if not found:
            break
        pieces.append(data[at : found.start()])
        at = found.end()
    return [*pieces, data[at:]] if at else [data]


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many words each text has."""
    counts = np.zeros(len(texts), np.int64)
    hashes: list[np.ndarray] = []
    parts: list[bytes] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if parts:
            found, at = _hash_words(parts)
            hashes.append(found)
            np.add.at(counts, np.asarray(owners)[at], 1)
        parts.clear()
        owners.clear()
        size = 0

    for i, text in enumerate(texts):
        if text:
            for piece in _pieces(text.encode("utf-8", "surrogatepass")):
                parts.append(piece)
                owners.append(i)
                size += len(piece) + 1
                if size >= PIECE_BYTES:
                    flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def _hash_words(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``parts``, and the part each word is in."""
    data = np.frombuffer(b" ".join(parts).translate(_LOWER), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    offsets = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def _folded(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    value = words[starts]
    for j in range(1, n):
        value = value * _STEP + words[starts + j]
    return value


def shingle_hashes(texts: Sequence[str | None], k: int = WORDS_PER_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, and how many each text has.

    A text of fewer words has its whole sequence as the only shingle; a text
    without words, or null, has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.empty(int(sizes.sum()), np.uint64)
    full = np.repeat(counts >= k, sizes)
    at = np.arange(len(words))
    starts = at[at + k <= np.repeat(ends, counts)]
    out[full] = mix(_folded(words, starts, k))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        values = np.empty(len(short), np.uint64)
        for n in range(1, k):
            of_n = counts[short] == n
            length = np.uint64(_SHORT * n % (1 << 64))
            values[of_n] = mix(_folded(words, (ends - counts)[short[of_n]], n) ^ length)
        out[~full] = values
    return out, sizes


def shingle_sets(texts: Sequence[str | None], k: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, sizes = shingle_hashes(texts, k)
    return [np.unique(part) for part in np.split(flat, np.cumsum(sizes)[:-1])] if len(sizes) else []
