"""Ranked lexical search over bit-sliced Bloom signatures.

The index is written once, in blocks of documents of like size:

* **Signature.** A document that holds a term f times enters (term, level) for each level with
  ``2 ** level <= f``; an entry sets ``HASHES`` bits. The bits of a block lie by slice: one bitmap over the block's documents
  for each bit, so the documents that may hold an entry are the AND of a few bitmaps. They are a superset.
* **Exact counts.** Each document's terms and their frequencies (``tallies``), to rescore without reading texts again.
* The block's vocabulary with document frequencies; their sums are those of the corpus.

A query adds up, slice by slice, the most that a term of that level can be worth in each document; this is an upper bound
of the score. Each task goes through its blocks once, rescores exactly the documents whose bound reaches the task's
own ``top``-th best score so far (equal ones too), and sends its best ones. A document that was not rescored is thus proven
to be outside the result; there is no cap. No text and no list of candidates is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.blocks import mix, stored_text
from shiftledger.llm.tallies import Tallies, parts, unpacked
from shiftledger.session import new_folder

TOP = 50
HASHES = 3
BITS_AN_ENTRY = 8  # at least so many bits per entry, at most twice as many
BLOCK_ROWS = 4096
BLOCK_ENTRIES = 400_000  # (document, term) pairs; more only for a single longer document
ITEMS_AT_ONCE = 1000  # queries whose terms are sent to the tasks together
TERMS_AT_ONCE = 200_000

#: A term is a run of other characters than these, A-Z in lower case (fixed values).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

INDEX = "width int, rows int, doc_ids array<long>, lengths array<long>, slices binary, words array<string>, holders array<int>, entries long, held binary"


def terms_of(text: Column) -> Column:
    """All terms of a text, with repeats; a null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def counted_terms(text: str, find, gap) -> Counter:
    """Each term's occurrences."""
    found: Counter = Counter()
    for part in parts(text, gap):
        found.update(find(part))
    low = str.maketrans(UPPER, LOWER)
    terms: Counter = Counter()
    for word, count in found.items():
        terms[word.lower() if word.isascii() else word.translate(low)] += count
    return terms


def hashes(terms: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms], np.uint64)


def bits_of(hashed: np.ndarray, level: int, width: int) -> np.ndarray:
    """(HASHES, n): the slices that the entries (term, level) set among ``2 ** width``."""
    spread = mix(hashed + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    shifts = np.arange(HASHES, dtype=np.uint64)[:, None] * np.uint64(64 // HASHES)
    return ((spread >> shifts) & np.uint64((1 << width) - 1)).astype(np.int64)


def level_count(counts: np.ndarray) -> np.ndarray:
    """The number of levels that a frequency enters: its binary digits."""
    return np.frexp(counts.astype(np.float64))[1]


class _Block:
    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.tallies = Tallies()

    def row(self, width: int) -> list:
        rows = len(self.ids)
        words, holders, held = self.tallies.packed()
        hashed = hashes(words)
        refs, counts = np.frombuffer(self.tallies.refs, "u4"), np.frombuffer(self.tallies.counts, "u4")
        docs = np.repeat(np.arange(rows), np.diff(np.frombuffer(self.tallies.cuts, "i8")))
        size = -(-rows // 8)
        slices = np.zeros((1 << width) * size, np.uint8)
        levels, level = level_count(counts), 0
        while (some := np.flatnonzero(levels > level)).size:
            bits = bits_of(hashed, level, width)
            for bit in bits:
                np.bitwise_or.at(slices, bit[refs[some]] * size + docs[some] // 8, (128 >> docs[some] % 8).astype(np.uint8))
            level += 1
        return [width, rows, self.ids, self.lengths, slices.tobytes(), words, holders.astype(np.int32), len(refs), held]


def _index_rows(batches: Iterator[pa.RecordBatch], block_rows: int, block_entries: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in INDEX.split(", ")]
    find, gap = re.compile(TERM).findall, re.compile(GAP)
    open_blocks: dict[int, _Block] = {}

    def full(width: int) -> pa.RecordBatch:
        values = open_blocks.pop(width).row(width)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            terms = counted_terms(text.as_py(), find, gap)
            entries = sum(map(int.bit_length, terms.values()))
            width = max(9, (BITS_AN_ENTRY * entries - 1).bit_length()) if entries else 9
            block = open_blocks.setdefault(width, _Block())
            if block.ids and (len(block.ids) >= block_rows or len(block.tallies.refs) + len(terms) > block_entries):
                yield full(width)
                block = open_blocks.setdefault(width, _Block())
            block.ids.append(doc_id)
            block.lengths.append(terms.total())
            block.tallies.add(terms)
    for width in list(open_blocks):
        yield full(width)


def write_index(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, block_rows: int = BLOCK_ROWS, block_entries: int = BLOCK_ENTRIES
) -> str:
    """Writes the index of all documents to the shared folder and returns its path.

    Null texts have no terms. Repeated rows are documents of their own, null ids stay null.
    A task holds one open block for each size of signature, so memory follows ``block_entries``.
    """
    folder = new_folder(docs.sparkSession, "signatures")
    docs.select(docs[doc_id].cast("long").alias("doc_id"), stored_text(docs, text).alias("text")).mapInArrow(
        lambda batches: _index_rows(batches, block_rows, block_entries), INDEX
    ).write.parquet(folder)
    return folder


@dataclass
class Item:
    """A query: its distinct terms and their weights."""

    number: int
    item_id: object
    terms: list[str]
    weights: np.ndarray


class _Best:
    """A task's best documents for one item so far: by score, then by id, null ids last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.lacks = np.empty(0, bool)

    @property
    def least(self) -> int:
        """Documents that may score less than this are out."""
        return int(self.scores[-1]) if len(self.scores) >= self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, lacks: np.ndarray) -> None:
        some = scores >= self.least
        scores, ids, lacks = (np.concatenate([old, new[some]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.lacks, lacks)))
        order = np.lexsort((ids, lacks, -scores))[: self.top]
        self.scores, self.ids, self.lacks = scores[order], ids[order], lacks[order]


def worth(counts: np.ndarray | int, norms: np.ndarray) -> np.ndarray:
    """What a term's occurrences are worth, before its weight."""
    return (1_000_000_000 * counts) // (1000 * counts + 20 * norms)


class _Searched:
    """One block of the index while items are looked up in it."""

    def __init__(self, row: dict, documents: int, all_terms: int) -> None:
        self.row, self.rows, self.width = row, row["rows"], row["width"]
        self.slices = np.frombuffer(row["slices"], np.uint8).reshape(1 << self.width, -1)
        self.lacks = np.array([x is None for x in row["doc_ids"]], bool)
        self.ids = np.array([0 if x is None else x for x in row["doc_ids"]], np.int64)
        lengths = row["lengths"]
        self.norms = np.array([50 + 50 * n * documents // all_terms for n in lengths], np.int64)
        self.exact = None
        self.gains: list[np.ndarray] = []

    def gain(self, level: int) -> np.ndarray:
        """How much more a term may be worth that reaches this level, not only the one below."""
        while len(self.gains) <= level:
            n = len(self.gains)
            self.gains.append(worth((2 << n) - 1, self.norms) - worth((1 << n) - 1, self.norms))
        return self.gains[level]

    def bounds(self, item: Item, hashed: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of all documents of the block."""
        bounds = np.zeros(self.rows, np.int64)
        level, alive, weights = 0, None, item.weights
        while len(hashed):
            bits = bits_of(hashed, level, self.width)
            held = self.slices[bits[0]]
            for bit in bits[1:]:
                held = held & self.slices[bit]
            if alive is not None:
                held &= alive
            some = held.any(axis=1)
            hashed, weights, alive = hashed[some], weights[some], held[some]
            if len(hashed):
                sums = weights.astype(np.float64) @ np.unpackbits(alive, axis=1, count=self.rows)
                bounds += sums.astype(np.int64) * self.gain(level)
            level += 1
        return bounds

    def scores(self, item: Item, docs: np.ndarray) -> np.ndarray:
        """Exact scores of some documents, from their own counts."""
        if self.exact is None:
            cuts, refs, counts = unpacked(self.row["held"], self.rows, self.row["entries"])
            places = {w: i for i, w in enumerate(self.row["words"])}
            self.exact = cuts, refs, counts, places, np.zeros(len(places), np.int64)
        cuts, refs, counts, places, weight_of = self.exact
        known = [(places[t], w) for t, w in zip(item.terms, item.weights.tolist(), strict=True) if t in places]
        at = np.array([k for k, _ in known], np.int64)
        weight_of[at] = [w for _, w in known]
        sizes = cuts[docs + 1] - cuts[docs]
        ends = np.cumsum(sizes)
        spread = np.repeat(cuts[docs] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        weights = weight_of[refs[spread]]
        weight_of[at] = 0
        hit = np.flatnonzero(weights)
        owners = np.repeat(np.arange(len(docs)), sizes)[hit]
        found = np.zeros(len(docs), np.int64)
        np.add.at(found, owners, weights[hit] * worth(counts[spread[hit]], self.norms[docs[owners]]))
        return found

    def search(self, item: Item, hashed: np.ndarray, best: _Best) -> int:
        """Rescores the documents whose bound reaches the best so far, highest bounds first; how many those were."""
        bounds = self.bounds(item, hashed)
        order = np.flatnonzero(bounds >= best.least)
        order = order[np.argsort(-bounds[order], kind="stable")]
        done, step = 0, best.top
        while done < len(order) and bounds[order[done]] >= best.least:
            some = order[done : done + step]
            best.add(self.scores(item, some), self.ids[some], self.lacks[some])
            done, step = done + len(some), 2 * step
        return done


def _found(batches: Iterator[pa.RecordBatch], items: list[Item], documents: int, all_terms: int, top: int) -> Iterator[pa.RecordBatch]:
    bests = [_Best(top) for _ in items]
    hashed = [hashes(item.terms) for item in items]
    rescored = 0
    for batch in batches:
        for at in range(batch.num_rows):
            block = _Searched(batch.slice(at, 1).to_pylist()[0], documents, all_terms)
            for item, codes, best in zip(items, hashed, bests, strict=True):
                rescored += block.search(item, codes, best)
    for item, best in zip(items, bests, strict=True):
        size = len(best.scores)
        yield pa.RecordBatch.from_arrays([
            pa.array([item.number] * size, pa.int64()), pa.array(best.ids, pa.int64(), mask=best.lacks), pa.array(best.scores, pa.int64()),
            pa.array([rescored] * size, pa.int64()),
        ], ["item_number", "doc_id", "score", "rescored"])


def _items(items: DataFrame, index: DataFrame, documents: int) -> Iterator[list[Item]]:
    """The items with weighted terms, in chunks of bounded size."""
    asked = items.select(F.explode("terms").alias("word")).distinct()
    held = index.select(F.explode(F.arrays_zip("words", "holders")).alias("x")).select("x.words", "x.holders")
    known = held.join(asked, held["words"] == asked["word"], "left_semi").groupBy("words").agg(F.sum("holders").alias("df"))
    each = items.select("item_number", "item_id", F.explode("terms").alias("term")).join(known, F.col("term") == known["words"])
    told = each.groupBy("item_number", "item_id").agg(F.collect_list(F.struct("term", "df")).alias("terms")).orderBy("item_number")
    chunk: list[Item] = []
    size = 0
    for row in told.toLocalIterator():
        terms = sorted((t.term, t.df) for t in row.terms)
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for _, df in terms], np.int64)
        if chunk and (len(chunk) >= ITEMS_AT_ONCE or size + len(terms) > TERMS_AT_ONCE):
            yield chunk
            chunk, size = [], 0
        chunk.append(Item(row.item_number, row.item_id, [t for t, _ in terms], weights))
        size += len(terms)
    if chunk:
        yield chunk


def ranked(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    *, top: int = TOP, **parameters,
) -> DataFrame:
    """The ``top`` best documents for each item: item_id, rank, doc_id, score, and rescored (documents its task scored exactly, for all items).

    Terms count by their frequency in the document, its length and their rarity, all in whole numbers. Only scores above 0 are ranked;
    equal scores go by doc_id, null last. Null or empty texts match nothing. Every row of ``docs`` and of ``items`` counts on its own, so
    repeated items have repeated results. Other columns, whatever their names, are left out. The items
    are sent to the tasks in chunks of at most 1,000 items and 200,000 terms (a longer single item is a chunk of its own), each of which
    goes through the whole index.
    """
    spark = docs.sparkSession
    index = spark.read.parquet(write_index(docs, text, doc_id, **parameters))
    counts = index.select(
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + (n > 0).cast("long")).alias("documents"),
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("terms"),
    ).agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).first()
    documents, all_terms = counts.documents or 0, counts.terms or 0
    folder = new_folder(spark, "items")
    items.select(
        items[item_id].alias("item_id"), F.array_distinct(terms_of(items[item_text].cast("string"))).alias("terms")
    ).withColumn("item_number", F.monotonically_increasing_id()).write.parquet(folder)
    asked = spark.read.parquet(folder)

    found = spark.createDataFrame([], "item_number long, doc_id long, score long, rescored long")
    if all_terms:
        for chunk in _items(asked, index, documents):
            found = found.unionByName(index.mapInArrow(
                lambda batches, chunk=chunk: _found(batches, chunk, documents, all_terms, top),
                "item_number long, doc_id long, score long, rescored long",
            ))
    best = Window.partitionBy("item_number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    held = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return held.join(asked.drop("terms"), "item_number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "rescored")
