import os
import random

import numpy as np
import pytest
from small import DOCS, awkward_rows, prose

from shiftledger.llm import toxicity
from shiftledger.llm.toxicity import decay_of, fit_curve, segments, toxic_passages, train

LABELS = "doc_id long, quality int, toxic int"


def maximal(scores):
    """All maximal scoring segments by their definition: the best segment, then the parts beside it."""
    if not len(scores):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(
        ((sums[b] - sums[a], -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
    )
    if best[0] <= 1e-12:
        return []
    _, _, _, a, b = best
    return [*maximal(scores[:a]), (a, b, sums[b] - sums[a]), *[(x + b, y + b, s) for x, y, s in maximal(scores[b:])]]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_the_maximal_ones(seed):
    rng = np.random.default_rng(seed)
    count = int(rng.integers(1, 40))
    told = np.flatnonzero(rng.random(count) < 0.5)
    odds = rng.normal(0, 2, len(told)) + 0.3
    scores = np.full(count, -0.1)
    scores[told] = odds
    found = segments(odds, told)
    want = maximal(scores)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in found], [s for *_, s in want])


def test_decay_is_the_root():
    scores, chances = np.array([3.0, 1.0, -0.1]), np.array([0.001, 0.004, 0.995])
    x = decay_of(scores, chances)
    assert x > 0 and abs((chances * np.exp(x * scores)).sum() - 1) < 1e-9
    assert decay_of(np.array([-0.1]), np.array([1.0])) == 1.0


def test_curve_separates():
    bias, slope = fit_curve(np.array([0.0, 0.0, 5.0, 5.0]), np.array([0.0, 1.0, 0.0, 1.0]), np.array([90.0, 10.0, 1.0, 99.0]))
    assert 1 / (1 + np.exp(-bias)) < 0.2 and 1 / (1 + np.exp(-bias - 5 * slope)) > 0.9


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    rows, labels, spans = [], [], {}
    for i in range(100, 700):
        text, toxic = prose(rng, rng.randint(40, 200)), int(rng.random() < 0.2)
        if toxic:
            held = text.split(" ")
            at = rng.randrange(len(held) - 8)
            held[at : at + 6] = [rng.choice(["Idiot", "scum", "filthka", "filthlo", "FILTHmi"]) for _ in range(6)]
            spans[i] = (len(" ".join(held[:at])) + (at > 0), len(" ".join(held[: at + 6])))
            text = " ".join(held)
        rows.append((i, text, "en", "a", 1))
        labels.append((i, None, toxic))
    labels += [(100, None, None), (None, 1, 1), (99_999, 1, 1)]
    docs = spark.createDataFrame([*rows, *awkward_rows()], DOCS)
    return docs, spark.createDataFrame(labels, LABELS), spans


def test_planted_passages_are_found(tables):
    docs, labels, spans = tables
    found = toxic_passages(docs, labels).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == int(r.doc_id in spans)
        if r.doc_id in spans:
            best = max(r.passages, key=lambda p: p.evidence)
            assert (best.start, best.end) == spans[r.doc_id]
            assert best.last_token - best.first_token == 6


def test_held_out_labels_are_not_learned(spark, tables):
    docs, labels, _ = tables
    import zlib

    other = labels.collect()
    turned = [(r.doc_id, r.quality, 1 - r.toxic if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic) for r in other]
    one, two = train(docs, labels), train(docs, spark.createDataFrame(turned, LABELS))
    assert (one.tokens == two.tokens).all() and (one.bias, one.slope, one.decay) == (two.bias, two.slope, two.decay)


def test_no_labels_and_no_rows(spark, tables):
    docs, labels, _ = tables
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxic_passages(docs, none).select("score").distinct().collect()} and train(docs, none).tokens.size == 0
    assert toxic_passages(docs.limit(0), labels).collect() == []
    assert toxicity.train(docs, labels.filter("toxic = 0")).tokens.size == 0


def test_the_scan_is_linear():
    """A drifting text with a million scattered positive tokens: quadratic time would take hours."""
    rng = np.random.default_rng(0)
    found = segments(rng.random(1_000_000) + 0.5, np.arange(1_000_000) * 40)
    assert len(found) == 1_000_000
    mixed = rng.normal(0, 1, 300_000)
    assert len(segments(mixed, np.arange(300_000), drift=0.0)) > 1000


@pytest.mark.parametrize(("size", "recall"), [("sf0.01", 0.6), ("sf0.1", 0.9)])  # 45 and 449 toxic labels
def test_held_out_labels_of_the_given_documents(spark, size, recall):
    folder = f"/root/testdata/{size}"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    told = labels.filter("toxic is not null").select("doc_id", "toxic")
    found = toxic_passages(docs, labels).filter("held_out").join(told, "doc_id").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in found if r.toxic]
    assert sum(toxic) >= recall * len(toxic) > 0
    assert not any(r.predicted for r in found if not r.toxic)
