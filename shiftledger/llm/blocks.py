"""Texts as byte blocks: words and their hashes for whole Arrow batches at a time.

A word is a run of bytes other than space and U+0009 to U+000D. Only these
functions run in Python tasks; a block holds about ``BLOCK_BYTES`` (more only
for a longer single text), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 4096
LONG_WORD = 512  # bytes; longer words are hashed with BLAKE2

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def stored_text(docs: DataFrame, text: str) -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text starts and ends in them."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    places = places.astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[places[0] : places[-1]], places - places[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts with about ``limit`` bytes."""
    data, offsets = bytes_of(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(rows, max(end, first + 1), first + BLOCK_TEXTS)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def ink(data: np.ndarray) -> np.ndarray:
    """True where a byte is not white space."""
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that end at text ends too: starts, ends, and per text the index of its first run."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def lowered_latin(data: np.ndarray) -> np.ndarray:
    """Like ``lowered``, and the letters of U+00C0 to U+00DE (in UTF-8) in lower case too."""
    low = lowered(data)
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    low[after] += np.uint8(32)
    return low


class Hasher:
    """Hashes byte spans by a polynomial modulo 2**64 from one running sum per block."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _reach(self, size: int) -> None:
        if size > len(self.up):
            room = max(size, BLOCK_BYTES + 1)
            up = np.full(room, _BASE, np.uint64)
            down = np.full(room, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return sums

    def heads(self, sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of spans at least as long, apart from those of whole words."""
        return mix((sums[starts + size] - sums[starts]) * self.down[starts] + np.uint64(size))

    def __call__(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None
    ) -> np.ndarray:
        sums = self.sums(data) if sums is None else sums
        found = mix((sums[ends] - sums[starts]) * self.down[starts])
        for at in np.flatnonzero(ends - starts > LONG_WORD):
            held = hashlib.blake2b(data[starts[at] : ends[at]].tobytes(), digest_size=8).digest()
            found[at] = np.frombuffer(held, np.uint64)[0]
        return found
