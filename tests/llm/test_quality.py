import random
import zlib

import numpy as np
from small import DOCS, awkward_rows, prose

from shiftledger.llm.quality import FEATURES, Statistics, fit_trees, keep_good, quality_scores, train

LABELS = "doc_id long, quality int, toxic int"


def made(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(100, 600):
        good = int(rng.random() < 0.7)
        text = prose(rng, rng.randint(30, 150))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), "menu | home\n" * 40])
        rows.append((i, text, "en", "a", 1))
        labels.append((i, good, 0))
    docs = spark.createDataFrame([*rows, *awkward_rows()], DOCS)
    return docs, spark.createDataFrame([*labels, (None, 1, 0), (101, None, 0)], LABELS), dict((a, b) for a, b, _ in labels)


def test_held_out_rows_are_told_apart(spark):
    docs, labels, truth = made(spark)
    found = quality_scores(docs, labels).collect()
    assert len(found) == docs.count()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 60
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in found)


def test_trees_walk_like_a_loop():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(500, 6)).astype(np.float32)
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] > 0)).astype(float)
    model = fit_trees(rows, labels, trees=20, depth=3)
    for row in rows[:50]:
        total = model.base
        for feature, limit, value in zip(model.feature, model.limit, model.value, strict=True):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + int(row[feature[at]] > limit[at])
            total += value[at - len(feature)]
        assert abs(total - model.margin(row[None, :])[0]) < 1e-9
    assert ((model.score(rows) > 0.5) == (labels > 0)).mean() > 0.95


def test_statistics_of_known_texts():
    texts = ["", "a b a\na b a\n", "AB!! 12 #"]
    raw = [t.encode() for t in texts]
    found = Statistics()(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    column = {name: found[:, i] for i, name in enumerate(FEATURES)}
    assert np.isfinite(found).all() and found.shape == (3, len(FEATURES))
    assert np.allclose(np.expm1(column["words"]), [0, 6, 3], atol=1e-5)
    assert np.allclose(column["distinct_words"], [0, 2 / 6, 1])
    assert np.allclose(column["commonest_word"], [0, 4 / 6, 1 / 3])
    assert np.allclose(column["repeats_of_previous"], [0, 1 / 6, 0])
    assert np.allclose(column["repeated_lines"][1], 0.5)
    assert np.allclose(column["upper_words"], [0, 0, 1 / 3]) and np.allclose(column["words_without_letters"][2], 2 / 3)
    assert np.allclose(column["words_with_symbols"][2], 2 / 3)


def test_no_labels_one_label_and_no_rows(spark):
    docs, labels, _ = made(spark)
    assert quality_scores(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert quality_scores(docs, labels.filter("quality = 1")).select("score").distinct().count() == 1
    assert quality_scores(docs.limit(0), labels).collect() == []
    assert len(train(docs, labels, bound=50).feature) > 0
