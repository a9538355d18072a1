"""How often each word stands in each document of a block, in little room.

A block numbers its distinct words and keeps, document by document, the numbers of
its words in ascending order with their counts. The numbers are stored as steps and
compressed, so a block takes about two bytes for each distinct word of a document.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa

LONG_TEXT = 1 << 20  # characters; longer texts are taken part by part


class Tallies:
    """Collects the word counts of one document after the other."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.refs = array("I")
        self.counts = array("I")
        self.cuts = array("q", [0])

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def add(self, counted: Mapping[str, int]) -> None:
        numbers = self.numbers
        for word, count in counted.items():
            self.refs.append(numbers.setdefault(word, len(numbers)))
            self.counts.append(count)
        self.cuts.append(len(self.refs))

    def packed(self) -> tuple[list[str], np.ndarray, bytes]:
        """The words, how many documents hold each, and the counts as bytes for ``unpacked``."""
        cuts, refs, counts = (np.frombuffer(x, t) for x, t in ((self.cuts, "i8"), (self.refs, "u4"), (self.counts, "u4")))
        rows = np.repeat(np.arange(len(self)), np.diff(cuts))
        order = np.lexsort((refs, rows))
        refs, counts = refs[order].astype(np.int64), counts[order]
        steps = np.diff(refs, prepend=0)
        first = cuts[:-1][np.diff(cuts) > 0]
        steps[first] = refs[first]  # each document starts anew
        held = np.concatenate([np.diff(cuts), steps, counts]).astype("<u4")
        return list(self.numbers), np.bincount(refs, minlength=len(self.numbers)), pa.compress(
            np.concatenate([[len(self), len(refs)], held]).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(),
            codec="zstd", asbytes=True,
        )


def unpacked(held: bytes, rows: int, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each document's words begin (and the last ends), the numbers of the words, and their counts."""
    size = 4 * (2 + rows + 2 * entries)
    raw = np.frombuffer(pa.decompress(held, size, codec="zstd"), np.uint8)
    held = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()[2:].astype(np.int64)
    sizes, steps, counts = held[:rows], held[rows : rows + entries], held[rows + entries :]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.cumsum(steps)
    before = np.concatenate([[0], sums])[cuts[:-1]]
    return cuts, sums - np.repeat(before, sizes), counts


def parts(text: str, border) -> Iterator[str]:
    """The text in parts of about ``LONG_TEXT`` characters that end where ``border`` (a pattern) matches nothing or a gap."""
    at = 0
    while len(text) - at > LONG_TEXT:
        cut = border.search(text, at + LONG_TEXT)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


