"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text come from its bytes, words and lines, a block of texts at
a time in numpy. Trees are fitted on a bounded sample of labelled rows
(``TRAINING_BOUND`` ids): each feature is cut into ``BINS`` quantile bins, every split is chosen
from histograms of gradients, and all trees have the same depth, so that they lie in flat
arrays which numpy walks for all texts of a block and all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.blocks import Hasher, blocks, ink, lowered, mix, spans
from shiftledger.llm.labelled import held_out, training_rows

TRAINING_BOUND = 20_000
BINS = 64
KINDS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:'\"()-?",
    b"!", b"|", b"#*$%&<>", bytes(range(128, 256)),
)  # one class of bytes each; all others are the last class
FEATURES = (
    "bytes", *(f"share_of_class_{i}" for i in range(len(KINDS) + 1)), "words", "word_bytes", "longest_word",
    "upper_words", "words_without_letters", "words_with_symbols", "distinct_words", "commonest_word", "repeats_of_previous",
    "distinct_triples", "lines", "words_per_line", "repeated_lines",
)


def _distinct(owners: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of distinct hashes and the count of the commonest."""
    if not len(hashes):
        return np.zeros(texts), np.zeros(texts)
    key = np.sort((owners.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - np.uint64(1)))
    owner = (key[first] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(texts)
    np.maximum.at(most, owner, np.diff(first, append=len(key)))
    return np.bincount(owner, minlength=texts).astype(float), most


class Statistics:
    """Features of a block of texts, one row each, in the order of ``FEATURES``."""

    def __init__(self) -> None:
        self.hasher = Hasher()
        self.kind = np.full(256, len(KINDS), np.int64)
        for i, held in enumerate(KINDS):
            self.kind[list(held)] = i

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        texts, classes = len(offsets) - 1, len(KINDS) + 1
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(texts), sizes)
        kinds = self.kind[data]
        counts = np.bincount(owner * classes + kinds, minlength=texts * classes).reshape(texts, classes)
        starts, ends, first = spans(ink(data), offsets)
        words = np.diff(first)
        of = np.repeat(np.arange(texts), words)
        length = (ends - starts).astype(float)
        some = np.maximum(words, 1)
        total = lambda x: np.bincount(of, weights=x, minlength=texts)

        def within(*wanted: int) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(np.isin(np.arange(classes), wanted)[kinds])])
            return sums[ends] - sums[starts]

        longest = np.zeros(texts)
        np.maximum.at(longest, of, length)
        letters, upper = within(0, 1, 9), within(1)
        hashes = self.hasher(lowered(data), starts, ends)
        distinct, commonest = _distinct(of, hashes, texts)
        again = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        triple = of[2:] == of[:-2]
        mixed = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))[triple]
        triples, _ = _distinct(of[2:][triple], mixed, texts)
        line_starts, line_ends, line_first = spans(data != 10, offsets)
        lines = np.diff(line_first)
        line_of = np.repeat(np.arange(texts), lines)
        distinct_lines, _ = _distinct(line_of, self.hasher(data, line_starts, line_ends), texts)
        return np.column_stack([
            np.log1p(sizes), counts / np.maximum(sizes, 1)[:, None], np.log1p(words), total(length) / some, np.log1p(longest),
            total((upper > 0) & (upper == letters)) / some, total(letters == 0) / some, total(within(6, 7, 8) > 0) / some,
            distinct / some, commonest / some, np.bincount(of[1:][again], minlength=texts) / some,
            triples / np.maximum(words - 2, 1), np.log1p(lines), words / np.maximum(lines, 1),
            1 - distinct_lines / np.maximum(lines, 1),
        ]).astype(np.float32)


@dataclass
class Trees:
    """Trees of one depth in flat arrays; node i has the children 2i+1 and 2i+2."""

    base: float
    depth: int
    feature: np.ndarray  # (trees, 2**depth - 1)
    limit: np.ndarray  # goes right above it
    value: np.ndarray  # (trees, 2**depth)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(rows))[:, None]
        node = np.zeros((len(rows), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (rows[row, self.feature[tree, node]] > self.limit[tree, node])
        return self.base + self.value[tree, node - (2**self.depth - 1)].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, ridge: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Boosts trees on the logistic loss; ``least`` is the smallest sum of second derivatives in a leaf.

    With no rows, or rows of one label only, the model is the smoothed share of label 1.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    nodes = 2**depth - 1
    if not len(labels) or labels.min() == labels.max():
        return Trees(base, depth, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes + 1)))
    limits = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in rows.T]
    binned = np.column_stack([np.searchsorted(cuts, column, side="left") for cuts, column in zip(limits, rows.T, strict=True)])
    feature, limit, value = [], [], []
    margin = np.full(len(labels), base)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = labels - chance, chance * (1 - chance)
        split, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        at = np.zeros(len(labels), np.int64)
        for level in range(depth):
            begin, here = 2**level - 1, 2**level
            best = np.zeros(here)
            for f, cuts in enumerate(limits):
                if not len(cuts):
                    continue
                key = (at - begin) * (len(cuts) + 1) + binned[:, f]
                g, h = (
                    np.bincount(key, weights=x, minlength=here * (len(cuts) + 1)).reshape(here, -1) for x in (slope, bend)
                )
                left_g, left_h = g.cumsum(axis=1), h.cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                left_g, left_h = left_g[:, :-1], left_h[:, :-1]
                gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
                gain[(left_h < least) | (all_h - left_h < least)] = 0
                most = gain.argmax(axis=1)
                better = gain[np.arange(here), most] > best + 1e-9
                best[better] = gain[np.arange(here), most][better]
                split[begin : begin + here][better] = f
                cut[begin : begin + here][better] = cuts[most[better]]
            at = 2 * at + 1 + (rows[np.arange(len(rows)), split[at]] > cut[at])
        leaf = at - nodes
        g, h = (np.bincount(leaf, weights=x, minlength=nodes + 1) for x in (slope, bend))
        leaves = rate * g / (h + ridge)
        margin = margin + leaves[leaf]
        feature.append(split), limit.append(cut), value.append(leaves)
    return Trees(base, depth, np.array(feature), np.array(limit), np.array(value))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    measure = Statistics()
    for batch in batches:
        found = [measure(data, offsets) for _, _, data, offsets in blocks(batch.column("text"))]
        flat = np.concatenate(found) if found else np.zeros((0, len(FEATURES)), np.float32)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("label"), pa.array([x.tobytes() for x in flat], pa.binary()),
        ], ["doc_id", "label", "features"])


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", bound: int = TRAINING_BOUND, text: str = "text",
    doc_id: str = "doc_id",
) -> Trees:
    """Fits the trees on at most ``bound`` labelled ids; of repeated ids one row counts."""
    found = (
        training_rows(docs, labels, label, bound, text=text, doc_id=doc_id)
        .select("doc_id", "label", "text")
        .mapInArrow(_feature_rows, "doc_id long, label int, features binary")
        .groupBy("doc_id").agg(F.max(F.struct("features", "label")).alias("held"))
        .select("doc_id", "held.label", "held.features")
        .toArrow()
    ).sort_by("doc_id")
    rows = np.frombuffer(b"".join(found["features"].to_pylist()), np.float32).reshape(-1, len(FEATURES))
    return fit_trees(rows, found["label"].to_numpy().astype(float))


def _scored_rows(batches: Iterator[pa.RecordBatch], model: Trees) -> Iterator[pa.RecordBatch]:
    measure = Statistics()
    for batch in batches:
        found = [model.score(measure(data, offsets)) for _, _, data, offsets in blocks(batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(np.concatenate(found) if found else np.zeros(0))],
            [*batch.schema.names[:-1], "the score"],
        )


def with_score(docs: DataFrame, model: Trees, text: str = "text", name: str = "quality_score") -> DataFrame:
    """The documents with one more column, the score from 0 to 1; null text counts as empty."""
    rows = docs.select("*", docs[text].cast("string").alias("the text"))
    schema = docs.withColumn("the score", F.lit(None).cast("double")).schema
    return rows.mapInArrow(lambda batches: _scored_rows(batches, model), schema).withColumnRenamed("the score", name)


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts get the score of their (zero) statistics. Repeated rows get
    equal scores, a null id is scored like any other, and an empty table gives no rows.
    Without usable labels every score is the same.
    """
    model = train(docs, labels, text=text, doc_id=doc_id)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return with_score(rows, model, name="score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _rated_rows(batches: Iterator[pa.RecordBatch], model: Trees, text: int) -> Iterator[pa.RecordBatch]:
    """Rows that hold a document as one struct, and its score; the text is read in the struct, not sent twice."""
    measure = Statistics()
    for batch in batches:
        column = batch.column(0).flatten()[text].cast(pa.string())
        found = [model.score(measure(data, offsets)) for _, _, data, offsets in blocks(column)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0))], ["held", "score"]
        )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns, whatever their names.

    Null and empty texts have the score of their (zero) statistics. Repeated rows stay or go together; an empty table stays empty.
    """
    model = train(docs, labels, text=text, doc_id=doc_id)
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("held"))
    place = docs.columns.index(text)
    schema = held.withColumn("score", F.lit(None).cast("double")).schema
    good = held.mapInArrow(lambda batches: _rated_rows(batches, model, place), schema).filter(F.col("score") >= threshold)
    return good.select(*[F.col("held")[c].alias(c) for c in docs.columns])
