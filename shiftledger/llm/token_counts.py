"""Token counts without token ids.

A byte-level BPE tokenizer splits a text into pre-tokens and each pre-token into
pieces, whatever stands around it. So the pieces of each distinct pre-token are counted
once, and a document's count is the sum over its pre-tokens of frequency times pieces.

1. Blocks of documents are cut into pre-tokens where they are read; a block keeps its distinct
   pre-tokens and each document's frequencies (``tallies``), and is written.
2. Each block sends its pre-tokens, each once, however often it stands there, to be sorted; so equal ones of all
   blocks meet, with no more rows than there are blocks, and the pieces of each are counted once.
3. A block gets the pieces of its pre-tokens back and sums for its documents.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.blocks import bytes_of, stored_text
from shiftledger.llm.tallies import Tallies, parts, unpacked
from shiftledger.session import new_folder

LIMIT = 1024
BLOCK_ROWS = 1 << 16
BLOCK_ENTRIES = 3_000_000  # (document, pre-token) pairs; more only for a single longer document

#: The pattern of byte-level pre-tokenizers (fixed values).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes are the same in all recent versions of Unicode; texts with others are cut by the tokenizer itself.
SETTLED = r"[\x00-՗‐-‧‰-⁞₠-₿←-⏿　-〿ぁ-ゖァ-ヿ一-龥가-힣ﬁﬂ]*+"
#: Between two words the pattern always cuts.
BORDER = r"(?<=\p{L}) (?=\p{L})"

BLOCK = (
    "doc_ids array<long>, n_bytes array<long>, specials array<long>, words array<string>, entries long, held binary"
)


class PreTokenizer:
    """Counts the pre-tokens of texts; special tokens are taken out first and counted as one each."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before = told.get("pre_tokenizer") or {}
        if (
            told.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or told["model"]["type"] != "BPE"
            or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in told["added_tokens"])
        ):
            raise ValueError("the tokenizer is not a plain byte-level BPE")
        self.special = [x["content"] for x in told["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.find, self.settled = regex.compile(PATTERN).findall, regex.compile(SETTLED).fullmatch
        self.border = regex.compile(BORDER)

    def words(self, text: str) -> list[str]:
        if self.settled(text):
            return self.find(text)
        return [text[low:high] for _, (low, high) in self.cut(text)]

    def __call__(self, text: str) -> tuple[Counter, int]:
        """The frequencies of the text's pre-tokens, and the number of special tokens in it."""
        pieces = self.specials.split(text) if any(x in text for x in self.special) else [text]
        counted: Counter = Counter()
        for piece in pieces:
            for part in parts(piece, self.border):
                counted.update(self.words(part))
        return counted, len(pieces) - 1


def _blocks(batches: Iterator[pa.RecordBatch], path: str, rows: int, entries: int) -> Iterator[pa.RecordBatch]:
    count = PreTokenizer(path)
    kinds = [pa.list_(pa.int64())] * 3 + [pa.list_(pa.string()), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in BLOCK.split(", ")]
    ids: list = []
    sizes: list = []
    specials: list = []
    held = Tallies()

    def full() -> pa.RecordBatch:
        words, _, packed = held.packed()
        values = [ids, sizes, specials, words, len(held.refs), packed]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        lengths = np.diff(bytes_of(batch.column(1))[1]).tolist()
        for doc_id, text, size in zip(batch.column(0).to_pylist(), batch.column(1), lengths, strict=True):
            words, special = count(text.as_py())
            if len(held) and (len(held) >= rows or len(held.refs) + len(words) > entries):
                yield full()
                ids, sizes, specials, held = [], [], [], Tallies()
            ids.append(doc_id)
            sizes.append(size)
            specials.append(special)
            held.add(words)
    if len(held):
        yield full()


def _pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The pieces of sorted words, each counted at its first row; place and pieces come back in one number."""
    tokenizer = PreTokenizer(path).tokenizer
    last, known = None, 0
    for batch in batches:
        words = batch.column(2).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        old = int(bool(distinct) and distinct[0] == last)  # goes on from the batch before
        coded = tokenizer.encode_batch_fast(distinct[old:], add_special_tokens=False)
        pieces = np.array([known] * old + [len(x.ids) for x in coded], np.int64)
        if distinct:
            last, known = distinct[-1], int(pieces[-1])
        places = batch.column(1).to_numpy().astype(np.int64)
        found = places << 32 | pieces[words.indices.to_numpy()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["block", "found"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids, sizes, specials, entries, held, found = (batch.column(i)[at] for i in range(6))
            pieces = np.zeros(0, np.int64)
            if found.is_valid:  # a block of empty texts has no pre-tokens
                told = found.values.to_numpy()
                pieces = np.zeros(len(told), np.int64)
                pieces[told >> 32] = told & 0xFFFFFFFF
            cuts, refs, counts = unpacked(held.as_py(), len(ids), entries.as_py())
            sums = np.concatenate([[0], np.cumsum(pieces[refs] * counts)])
            tokens = sums[cuts[1:]] - sums[cuts[:-1]] + specials.values.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [ids.values, sizes.values, pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )


def token_counts(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", *, limit: int = LIMIT,
    block_rows: int = BLOCK_ROWS, block_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers`` library that every executor can
    read; its counts are those of that library without added tokens, truncation or padding. Special
    tokens that stand in a text count as one each, as they do there. Null texts count as empty (no tokens). Repeated
    rows and null ids are counted each on their own; other columns, whatever their names, are left out.
    Long texts are cut into parts between words, so memory follows the distinct pre-tokens of a block.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "pretokens")
    docs.select(docs[doc_id].cast("long").alias("doc_id"), stored_text(docs, text).alias("text")).mapInArrow(
        lambda batches: _blocks(batches, tokenizer, block_rows, block_entries), BLOCK
    ).withColumn("block", F.monotonically_increasing_id()).write.parquet(folder)

    blocks = spark.read.parquet(folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    pieces = words.repartition(tasks, "word").sortWithinPartitions("word").mapInArrow(
        lambda batches: _pieces(batches, tokenizer), "block long, found long"
    )
    found = pieces.groupBy("block").agg(F.collect_list("found").alias("found"))
    joined = blocks.join(found, "block", "left").select("doc_ids", "n_bytes", "specials", "entries", "held", "found")
    counted = joined.mapInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
