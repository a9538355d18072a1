"""Packing by power-of-two decomposition.

A document's token ids (its text, then one end id) are cut, from the front, into
as many pieces of ``longest`` ids as fit, and the rest into pieces of the
lengths of its binary digits. Each piece is a sequence of its own whose
length is a power of two: nothing is padded, and no sequence crosses documents. Batches
are drawn from buckets of one length each.

Every step looks at one row only, so nothing is shuffled. A document is tokenized
by its chunks: the tokenizer treats white space as a border, so a white-space
separated chunk has the same ids wherever it stands, and the chunks seen before come
from a table in the task (at most ``CACHE_IDS`` ids, then it starts anew). With
``split_words`` a chunk of plain letters and punctuation is cut further, where the
two meet, and A-Z is lowered, so that there are fewer distinct chunks to tokenize.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm.blocks import Hasher, blocks, ink, lowered, spans

LONGEST = 2048
END_ID = 1
CACHE_IDS = 6_000_000
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Like ``spans`` of the white-space separated chunks, with plain chunks cut where letters and punctuation meet.

    A chunk is plain if it has no digit, apostrophe, ``<``, control character or
    non-ASCII character other than the letters of U+00C0 to U+00FF. The bytes come back
    with A-Z of plain chunks lowered; last comes whether each piece is plain.
    """
    if not len(data):
        return data, *spans(np.zeros(0, bool), offsets), np.zeros(0, bool)
    solid = ink(data)
    starts, ends, _ = spans(solid, offsets)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    lead = data == 0xC3
    tail = np.zeros(len(data), bool)
    tail[1:] = lead[:-1] & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    lead[:-1] &= tail[1:]
    lead[-1:] = False
    letter |= lead | tail
    odd = solid & ~letter & ((data < 33) | (data > 126) | ((data >= 48) & (data <= 57)) | (data == 39) | (data == 60))
    sums = np.concatenate([[0], np.cumsum(odd)])
    plain = np.zeros(len(data) + 1, np.int8)
    whole = sums[ends] == sums[starts]
    plain[starts[whole]] += 1
    plain[ends[whole]] -= 1
    inside = np.cumsum(plain[:-1], dtype=np.int8).astype(bool)
    meet = np.zeros(len(data) + 1, bool)
    meet[1:-1] = inside[1:] & inside[:-1] & (letter[1:] != letter[:-1])
    first, last = meet[:-1].copy(), meet.copy()
    first[starts], last[ends] = True, True
    starts = np.flatnonzero(first)
    return np.where(inside, lowered(data), data), starts, np.flatnonzero(last), np.searchsorted(starts, offsets), inside[starts]


class ChunkTokenizer:
    """Token ids of byte blocks by way of their distinct chunks."""

    def __init__(self, path: str, border: str, split_words: bool, cache_ids: int = CACHE_IDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.split_words, self.cache_ids = split_words, cache_ids
        self.tokenizer = Tokenizer.from_file(path)
        self.border = border  # a special token, set between chunks
        self.border_id = self.tokenizer.token_to_id(border)
        if self.border_id is None:
            raise ValueError(f"the tokenizer has no token {border!r}")
        self.hasher = Hasher()
        free = iter(range(256, 512))  # byte-level vocabularies name bytes that do not print from U+0100 on
        self.names = {b: b if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else next(free) for b in range(256)}
        self.checked = False
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of chunks
        self.first = np.zeros(0, np.int64)  # where the ids of each begin
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of chunks by the whole tokenizer, many chunks to a call with borders between them."""
        found = []
        for at in range(0, len(texts), 2000):
            some = texts[at : at + 2000]
            coded = self.tokenizer.encode(self.border.join("" if self.border in t else t for t in some), add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            found += [x[x != self.border_id] for x in np.split(ids, np.flatnonzero(ids == self.border_id))]
        for i, text in enumerate(texts):
            if self.border in text:
                found[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return found

    def _plain(self, texts: list[str]) -> list[list[int]]:
        """Ids of plain pieces by the vocabulary's merges alone."""
        merge = self.tokenizer.model.tokenize
        named = (t if t.isascii() else t.lower().encode().decode("latin-1").translate(self.names) for t in texts)
        return [[x.id for x in merge(t)] for t in named]

    def _learn(self, hashes: np.ndarray, chunks: list[bytes], plain: np.ndarray) -> None:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        simple = np.flatnonzero(plain)
        if len(simple) and not self.checked:  # does the short way suit this tokenizer?
            some = [texts[i] for i in simple[:500]]
            if [list(x) for x in self._whole(some)] != self._plain(some):
                raise ValueError("split_words does not suit this tokenizer")
            self.checked = True
        found: list = [None] * len(texts)
        for some, way in ((simple, self._plain), (np.flatnonzero(~plain), self._whole)):
            for i, ids in zip(some, way([texts[i] for i in some]), strict=True):
                found[i] = ids
        count = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]])
        self.ids = np.concatenate([self.ids, np.fromiter((x for ids in found for x in ids), np.uint32, int(count.sum()))])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and where each text's ids begin and end."""
        if self.split_words:
            data, starts, ends, words, plain = _cuts(data, offsets)
        else:
            starts, ends, words = spans(ink(data), offsets)
            plain = np.zeros(len(starts), bool)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes, at, back = np.unique(self.hasher(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.ids) > self.cache_ids:
            self._forget()
        place = np.searchsorted(self.known, hashes)
        new = place == len(self.known)
        new[~new] = self.known[place[~new]] != hashes[~new]
        if new.any():
            view = memoryview(np.ascontiguousarray(data))
            self._learn(hashes[new], [bytes(view[starts[i] : ends[i]]) for i in at[new]], plain[at[new]])
            place = np.searchsorted(self.known, hashes)
        count = self.count[place][back]
        ends_of = np.cumsum(count)
        steps = np.arange(ends_of[-1]) - np.repeat(ends_of - count, count)
        ids = self.ids[np.repeat(self.first[place][back], count) + steps]
        return ids, np.concatenate([[0], ends_of])[words]


def piece_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """The pieces of a document with so many tokens, in order."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _piece_rows(
    batches: Iterator[pa.RecordBatch], path: str, border: str, split_words: bool, longest: int, end_id: int, with_ids: bool,
    cache_ids: int,
) -> Iterator[pa.RecordBatch]:
    chunked = ChunkTokenizer(path, border, split_words, cache_ids)
    for batch in batches:
        docs = batch.column(0)
        for low, high, data, offsets in blocks(batch.column(1)):
            ids, borders = chunked(data, offsets)
            ids = np.insert(ids, borders[1:], end_id).astype("<i4")  # the pieces in order are all ids in order
            raw, at = memoryview(ids.tobytes()), 0
            lengths, starts, crcs, totals, owners = [], [], [], [], []
            for row, tokens in enumerate(np.diff(borders) + 1):
                start = 0
                for length in piece_lengths(int(tokens), longest):
                    lengths.append(length)
                    starts.append(start)
                    crcs.append(zlib.crc32(raw[4 * at : 4 * (at + length)]))
                    totals.append(tokens)
                    owners.append(row)
                    start += length
                    at += length
            cut = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                docs.slice(low, high - low).take(pa.array(owners, pa.int64())),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(ids, pa.int32())) if with_ids else pa.nulls(len(owners), pa.list_(pa.int32())),
            ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    border: str = "<|startoftext|>",
    split_words: bool = True,
    longest: int = LONGEST,
    end_id: int = END_ID,
    with_ids: bool = True,
    cache_ids: int = CACHE_IDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is the path of a tokenizer file that every executor can read;
    its vocabulary must treat white space as a border. ``border`` is one of its special
    tokens. ``split_words`` holds for tokenizers that ignore the case of A-Z and whose
    pattern parts runs of letters from runs of punctuation. ``longest`` is a power of two. Without ``with_ids`` the column
    ``ids`` is null; ``cache_ids`` bounds a task's table of known chunks. Null and empty texts consist of the end id alone. Repeated rows are
    packed each on their own; a null id stays null. Other columns are left out.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    pieces = rows.mapInArrow(
        lambda batches: _piece_rows(batches, tokenizer, border, split_words, longest, end_id, with_ids, cache_ids), PIECE
    )
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Writes the sequences with one subfolder per length, so that a reader takes batches of equal length."""
    pieces.write.partitionBy("length").mode("overwrite").parquet(folder)


def read_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The sequences of all buckets, with the columns of ``pack``; every file holds one length."""
    kinds = f"{PIECE.removesuffix(', ids array<int>')}, sequence_id long, offset long, ids array<int>"
    held = spark.read.schema(kinds).parquet(folder)
    return held.select(*[c.split()[0] for c in kinds.split(", ")])
