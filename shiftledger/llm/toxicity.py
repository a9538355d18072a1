"""Toxic passages by maximum-scoring segment search over token log-odds.

A token is a run of letters (in lower case) or of bytes outside ASCII. Inflected
words share their beginning, so a token also has stems: its first ``STEMS``
bytes. From a bounded sample of labelled documents, equal texts counted once, each
token and stem gets the log-odds of the documents that hold it, toxic against
clean, with an informative Dirichlet prior: pseudo-counts in proportion to its
share of all documents. Where the likelihood-ratio statistic against equal shares is below
``LEAST_RATIO``, it counts as ordinary. A token scores the log-odds of its longest
form that is not ordinary; ordinary tokens score a small loss ``DRIFT``, so clean text
drifts downwards.

One pass over a text finds all maximal scoring segments (Ruzzo and Tompa). Under clean
text the best segment of n tokens follows an extreme-value law,
P(S >= x) = 1 - exp(-K n exp(-lambda x)) (Karlin and Altschul): lambda is the root of
E[exp(lambda s)] = 1 over clean tokens and K is its likelihood estimate from the best segments of clean
documents. A segment's evidence is lambda S - ln(K n); those above zero (fewer than one expected by
chance) are the significant passages. The evidence of a document is their sum, and a logistic curve
fitted to the labelled sample turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.blocks import Hasher, blocks, lowered_latin, spans
from shiftledger.llm.labelled import held_out, training_rows

TRAINING_BOUND = 40_000
PRIOR_SHARE = 0.02  # total pseudo-count as a share of all counts
LEAST_RATIO = 25.0  # about five standard errors; lower ones find no more held-out documents and more clean ones
STEMS = (4, 5, 6, 7)
DRIFT = 0.1
EVIDENCE_STEP = 0.25  # width of the bins that the logistic curve is fitted on
SEGMENTS = "array<struct<start: int, end: int, first_token: int, last_token: int, evidence: double>>"


@dataclass
class Model:
    tokens: np.ndarray  # sorted hashes of the tokens that are not ordinary
    odds: np.ndarray
    decay: float = 1.0  # lambda
    scale: float = 1.0  # K
    bias: float = 0.0
    slope: float = 1.0

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * evidence, -30, 30)))


def segments(scores: np.ndarray, places: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text: (first token, end token, score).

    ``scores`` are those of the tokens at ``places``; every other token scores
    ``-drift``. Only the listed tokens are visited. Each held segment links to the last one that begins at a smaller sum, so a
    segment that was passed over once is not met again and the time is linear in the listed tokens.
    """
    found: list[list[float]] = []  # first, end, sum before it, sum up to its end
    lower: list[int] = []  # per held segment, the last one before it with a smaller sum before it, or -1
    level, seen = 0.0, 0
    for score, place in zip(scores.tolist(), places.tolist(), strict=True):
        level -= drift * (place - seen)
        before, level, seen = level, level + score, place + 1
        if score <= 0:
            continue
        now, at = [place, place + 1, before, level], len(found) - 1
        while at >= 0:
            if found[at][2] < before:
                if found[at][3] >= level:
                    break
                now[0], now[2] = found[at][0], found[at][2]
                before, first = now[2], lower[at]
                del found[at:], lower[at:]
                at = first
            else:
                at = lower[at]  # those between begin no lower
        found.append(now)
        lower.append(at)
    return [(int(a), int(b), high - low) for a, b, low, high in found]


class TokenReader:
    """Tokens of a block: starts, ends, index of each text's first token, and the hashes of their forms."""

    def __init__(self) -> None:
        self.hasher = Hasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """``forms`` has (tokens, hashes) of the whole tokens and then of ever shorter stems."""
        low = lowered_latin(data)
        starts, ends, first = spans(((low >= 97) & (low <= 122)) | (low >= 128), offsets)
        sums = self.hasher.sums(low)
        forms = [(np.arange(len(starts)), self.hasher(low, starts, ends, sums))]
        for size in STEMS[::-1]:
            some = np.flatnonzero(ends - starts > size)
            forms.append((some, self.hasher.heads(sums, starts[some], size)))
        return starts, ends, first, forms


def _told(model: Model, forms: list[tuple[np.ndarray, np.ndarray]], tokens: int) -> np.ndarray:
    """Per token, the place in the model of its longest form that is not ordinary, or -1."""
    place = np.full(tokens, -1, np.int64)
    for some, hashes in forms if len(model.tokens) else ():
        at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
        new = (model.tokens[at] == hashes) & (place[some] < 0)
        place[some[new]] = at[new]
    return place


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: for each form the number of toxic and of clean documents that hold it; -1 for all forms."""
    read = TokenReader()
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False) > 0
        for low, high, data, offsets in blocks(batch.column("text")):
            _, _, first, forms = read(data, offsets)
            of = np.repeat(np.arange(low, high), np.diff(first))
            owner, hashes = np.concatenate([of[x] for x, _ in forms]), np.concatenate([x for _, x in forms])
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            tokens, back = np.unique(hashes[new], return_inverse=True)
            toxic = np.bincount(back, weights=label[owner[new]], minlength=len(tokens)).astype(np.int64)
            every = np.bincount(back, minlength=len(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["token", "toxic", "clean"]
            )


def _token_odds(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and log-odds of the forms that tell toxic from clean documents."""
    counts = (
        sample.select("label", "text").mapInArrow(_token_counts, "token long, toxic long, clean long")
        .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()[0]
    docs = sample.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).collect()[0]
    in_toxic, in_clean = float(total.toxic or 0), float(total.clean or 0)
    if not in_toxic or not in_clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    share = docs.toxic / docs.n
    mass = PRIOR_SHARE * (in_toxic + in_clean)
    held = F.col("toxic") + F.col("clean")
    prior = F.lit(PRIOR_SHARE) * held
    toxic, clean = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(toxic / (F.lit(in_toxic + mass) - toxic)) - F.log(clean / (F.lit(in_clean + mass) - clean))
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / (held * F.lit(expected)))).otherwise(0.0)
    ratio = 2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))
    told = (
        counts.withColumn("odds", odds).filter(ratio > LEAST_RATIO).select("token", "odds").toArrow()
    )  # few of the bounded sample's forms are told apart
    tokens = told["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], told["odds"].to_numpy()[order]


class Finder:
    """Scoring segments of the texts of a block."""

    def __init__(self, model: Model) -> None:
        self.model, self.read = model, TokenReader()

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """Yields per text its number of tokens and its segments: byte span, token span, score."""
        starts, ends, first, forms = self.read(data, offsets)
        place = _told(self.model, forms, len(starts))
        told = np.flatnonzero(place >= 0)
        odds = self.model.odds[place[told]] if len(told) else np.zeros(0)
        border = np.searchsorted(told, first)
        for text in range(len(offsets) - 1):
            some = slice(border[text], border[text + 1])
            found = segments(odds[some], told[some] - first[text])
            yield int(first[text + 1] - first[text]), [
                (int(starts[first[text] + a] - offsets[text]), int(ends[first[text] + b - 1] - offsets[text]), a, b, s)
                for a, b, s in found
            ]


def _best_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    find = Finder(model)
    for batch in batches:
        sizes, best, sums = [], [], []
        for _, _, data, offsets in blocks(batch.column("text")):
            for tokens, found in find(data, offsets):
                sizes.append(tokens)
                best.append(max((x[4] for x in found), default=0.0))
                sums.append([x[4] for x in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(sizes, pa.int64()), pa.array(best, pa.float64()), pa.array(sums, pa.list_(pa.float64()))],
            ["label", "tokens", "best", "sums"],
        )


def _told_counts(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per batch, how often clean texts hold each token that is not ordinary, and all tokens (at -1)."""
    read = TokenReader()
    for batch in batches:
        counts, every = np.zeros(len(model.tokens), np.int64), 0
        for _, _, data, offsets in blocks(batch.column("text")):
            starts, _, _, forms = read(data, offsets)
            every += len(starts)
            place = _told(model, forms, len(starts))
            counts += np.bincount(place[place >= 0], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(counts[some], every))], ["place", "n"]
        )


def decay_of(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of E[exp(x s)] = 1; 1 where clean text never scores above zero."""
    if not (scores[chances > 0] > 0).any() or (scores * chances).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((chances * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while value(high) < 0:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return (low + high) / 2


def fit_curve(evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton's method, with a faint ridge; the slope is at least 0."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    at = np.zeros(2)
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weights * (labels - chance)) - 1e-3 * at
        bend = (x * (weights * chance * (1 - chance))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at + step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), max(float(at[1]), 0.0)


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", bound: int = TRAINING_BOUND, text: str = "text",
    doc_id: str = "doc_id",
) -> Model:
    """Fits the model on at most ``bound`` labelled ids; without both labels the score is their smoothed share."""
    sample = training_rows(docs, labels, label, bound, text=text, doc_id=doc_id)
    sample = (
        sample.groupBy(F.xxhash64(F.lower("text")).alias("same")).agg(F.max(F.struct("label", "text")).alias("held"))
        .select("held.label", "held.text")
    )
    tokens, odds = _token_odds(sample)
    model = Model(tokens, odds)
    held = (
        sample.filter("label = 0").select("text").mapInArrow(lambda b: _told_counts(b, model), "place long, n long")
        .groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    place, n = held["place"].to_numpy(), held["n"].to_numpy()
    every = max(int(n[place < 0].sum()), 1)
    chances = np.zeros(len(tokens) + 1)
    chances[place[place >= 0]] = n[place >= 0] / every
    chances[-1] = 1 - chances[:-1].sum()
    model.decay = decay_of(np.append(odds, -DRIFT), chances)

    best = sample.select("label", "text").mapInArrow(
        lambda b: _best_rows(b, model), "label int, tokens long, best double, sums array<double>"
    )
    clean = best.filter("label = 0 and tokens > 0").agg(
        F.count("*").alias("n"), F.sum(F.col("tokens") * F.exp(-model.decay * F.col("best"))).alias("mass")
    ).collect()[0]
    model.scale = (clean.n or 1) / (clean.mass or 1.0)
    log_n = F.log(F.lit(model.scale) * F.greatest("tokens", F.lit(1)))
    evidence = F.aggregate(
        "sums", F.lit(0.0), lambda held, s: held + F.greatest(F.lit(0.0), F.lit(model.decay) * s - log_n)
    )
    bins = (
        best.groupBy(F.floor(F.least(evidence, F.lit(200.0)) / EVIDENCE_STEP).alias("bin"), "label").count().toArrow()
    )  # at most 2 * 200 / EVIDENCE_STEP rows
    model.bias, model.slope = fit_curve(
        np.minimum(bins["bin"].to_numpy() * EVIDENCE_STEP, 200.0), (bins["label"].to_numpy() > 0).astype(float),
        bins["count"].to_numpy().astype(float),
    )
    return model


def _passage_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    find = Finder(model)
    for batch in batches:
        evidence, passages = [], []
        for _, _, data, offsets in blocks(batch.column("text")):
            for row, (tokens, found) in enumerate(find(data, offsets)):
                shift = np.log(model.scale * max(tokens, 1))
                rated = [(*x[:4], model.decay * x[4] - shift) for x in found]
                kept = [x for x in rated if x[4] > 0]
                if kept:  # byte places become places of characters
                    heads = np.cumsum((data[offsets[row] : offsets[row + 1]] & 0xC0) != 0x80)
                    kept = [
                        (int(heads[a - 1]) if a else 0, int(heads[b - 1]), first, last, x) for a, b, first, last, x in kept
                    ]
                passages.append([dict(zip(("start", "end", "first_token", "last_token", "evidence"), x, strict=True)) for x in kept])
                evidence.append(sum(x[4] for x in kept))
        evidence_of = np.array(evidence, float)
        kind = pa.list_(pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("first_token", pa.int32()), ("last_token", pa.int32()),
            ("evidence", pa.float64()),
        ]))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(model.score(evidence_of)), pa.array(evidence_of), pa.array(passages, kind),
        ], ["doc_id", "score", "evidence", "passages"])


def toxic_passages(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, bound: int = TRAINING_BOUND, text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence, passages.

    ``passages`` lists the significant segments in order: start and end as
    places of characters (end exclusive), first and last (exclusive) token, evidence; the column ``evidence`` is their sum. Null text
    counts as empty; texts without evidence, empty ones too, get the lowest score. Repeated rows get equal
    rows, null ids are kept, an empty table gives no rows, and other columns, whatever their names, are not read.
    """
    model = train(docs, labels, bound=bound, text=text, doc_id=doc_id)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    found = rows.mapInArrow(
        lambda b: _passage_rows(b, model), f"doc_id long, score double, evidence double, passages {SEGMENTS}"
    )
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "passages",
    )
