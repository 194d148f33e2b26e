"""Allow and block decisions for URLs by a bit-parallel wildcard automaton.

All glob rules are packed, one bit per state, into the words of one Shift-And
automaton; a step over one byte advances every rule at once, and a batch of
URLs goes through it side by side. In a glob ``*`` stands for any run of bytes
without a slash and ``**`` for any run; the whole canonical URL must match.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Decides for a host and its subdomains, for paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


# The rules given for the pages.
HOST_RULES = (
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)
# Where no host rule fits, a URL that matches one of these is blocked.
BLOCKED = (
    "ads.**",
    "*.ads.*/**",
    "ad.*/**",
    "track.*/**",
    "tracker.*/**",
    "*.doubleclick.*/**",
    "**/ads/**",
    "**/banner/**",
    "**/cart/**",
    "**/checkout/**",
    "**/login**",
    "**/signin**",
    "**/wp-admin/**",
    "**/wp-login**",
    "**.apk",
    "**.exe",
    "**.gif",
    "**.iso",
    "**.jpg",
    "**.mp4",
    "**.png",
    "**.zip",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty for null or without ``://``."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, found, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, found, 2), F.lit(""))


class Globs:
    """Compiled globs; :meth:`match` runs many byte strings through all of them."""

    def __init__(self, globs: Sequence[str]) -> None:
        self.globs = tuple(globs)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """For each byte the states it leads into and those it may stay in; first and last states."""
        compiled = [_compile(glob) for glob in self.globs]
        width = -(-sum(len(literal) + 1 for literal, _ in compiled) // 64) or 1
        step, stay = np.zeros((256, width), np.uint64), np.zeros((256, width), np.uint64)
        first, last = np.zeros(width, np.uint64), []
        base = 0
        for literal, loops in compiled:
            _set(first, base)
            for i, byte in enumerate(literal):
                _set(step[byte], base + i + 1)
            for state, across in loops.items():
                for byte in range(256):
                    if across or byte != ord("/"):
                        _set(stay[byte], base + state)
            base += len(literal)
            last.append(base)
            base += 1
        return step, stay, first, last

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Which globs each text matches as a whole, as a Boolean matrix."""
        step, stay, first, last = self.tables
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
        data = np.frombuffer(b"".join(texts), np.uint8)
        states = np.broadcast_to(first, (len(texts), len(first))).copy()
        running = len(texts)
        for at in range(int(sizes[0]) if len(sizes) else 0):
            running = int(np.searchsorted(-sizes[:running], -at))
            now = states[:running]
            byte = data[starts[:running] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:running] = (moved & step[byte]) | (now & stay[byte])
        found = np.zeros((len(texts), len(last)), bool)
        for i, bit in enumerate(last):
            found[order, i] = (states[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        return found


def _compile(glob: str) -> tuple[bytes, dict[int, bool]]:
    """A glob's literal bytes, and the states that loop (and whether across slashes)."""
    literal, loops = b"", {}
    pieces = glob.split("*")
    for i, piece in enumerate(pieces):
        literal += piece.encode()
        if i < len(pieces) - 1:
            # Two stars in a row loop in one state, and then across slashes.
            loops[len(literal)] = len(literal) in loops and piece == ""
    return literal, loops


def _set(words: np.ndarray, bit: int) -> None:
    words[bit // 64] |= np.uint64(1 << (bit % 64))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[HostRule] = HOST_RULES,
    blocked: Sequence[str] = BLOCKED,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, glob`` for every row of ``pages``.

    ``rule`` is the longest host rule that fits (of equal ones the later), else
    null; ``verdict`` is its action. Without one a URL that matches a glob of
    ``blocked``, of which the first is named in ``glob``, is blocked, and any
    other allowed. The canonical URL is host and path. Null urls and those
    without ``://`` have neither and are allowed. Repeated rows are judged
    alike; other columns are not read.
    """
    by_length = sorted(rules, key=lambda rule: len(rule.name))
    globs = Globs([glob for rule in by_length for glob in rule.globs] + list(blocked))
    actions = [rule.action for rule in by_length]
    names = [rule.name for rule in by_length]
    host, path = url_parts(F.col("url"))
    schema = T.StructType(
        [
            T.StructField("page_id", pages.schema["page_id"].dataType),
            *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict", "glob")],
        ]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [
                (h + p).encode("utf-8", "surrogatepass")
                for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            found = globs.match(urls)
            fits = found[:, : 2 * len(names)].reshape(len(urls), len(names), 2).any(axis=2)
            bad = found[:, 2 * len(names) :]
            rule, verdict, glob = [None] * len(urls), ["allow"] * len(urls), [None] * len(urls)
            for i in np.flatnonzero(fits.any(axis=1) | bad.any(axis=1)):
                if fits[i].any():
                    best = int(np.flatnonzero(fits[i])[-1])
                    rule[i], verdict[i] = names[best], actions[best]
                else:
                    verdict[i], glob[i] = "block", blocked[int(np.argmax(bad[i]))]
            texts = [pa.array(values, pa.string()) for values in (rule, verdict, glob)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *texts], names=schema.names)

    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(judged, schema)
