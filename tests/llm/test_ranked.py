import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from small import DOCS, awkward_rows, lowered, prose

from shiftledger.llm import queries, ranked, tallies

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lowered(text))


def expected(docs, items, top=50):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    documents = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in counted:
            score = 0
            for t in set(terms(text)) & c.keys():
                norm = 50 + 50 * c.total() * documents // total
                weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * norm))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=str)


def plain(frame):
    return sorted((tuple(r)[:4] for r in frame.drop("rescored").collect()), key=str)


def test_same_as_scoring_every_document(spark):
    rng = random.Random(5)
    common = prose(rng, 30)
    rows = [(i, prose(rng, rng.choice([3, 40, 400])) + (" " + common if i % 7 == 0 else "") + " the" * rng.randint(0, 9)) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # ties
    items = [(1, common), (2, rows[3][1]), (3, "THE"), (4, "no such words"), (5, None), (6, ""), (None, rows[9][1]), (1, common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for top, parameters in ((50, {}), (3, {"block_rows": 20, "block_entries": 500})):
        assert plain(ranked.ranked(docs, asked, top=top, **parameters)) == expected(rows, items, top)


def test_awkward_rows_and_clashing_names(spark):
    rows = awkward_rows()
    items = [(1, "one no id same line x"), (2, rows[10][1]), (3, "İ K ﬁ \x00 nul")]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], DOCS + ", rank int, words string")
    asked = spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, score long")
    assert plain(ranked.ranked(docs, asked, top=4)) == expected([r[:2] for r in rows], items, 4)
    none = spark.createDataFrame([], DOCS)
    assert ranked.ranked(none, asked).collect() == [] and ranked.ranked(docs, asked.limit(0)).collect() == []


def test_few_documents_are_rescored(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 200)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = [(i, " ".join(rows[i][1].split()[:30])) for i in range(5)]
    found = ranked.ranked(docs, spark.createDataFrame(items, "item_id long, text string"), top=10)
    assert {r.doc_id for r in found.filter("rank = 1").collect()} == {0, 1, 2, 3, 4}
    assert max(r.rescored for r in found.collect()) < 5 * 3000 / 3


def test_signatures_never_miss_an_entry():
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 60)) * rng.randint(1, 9) for _ in range(50)]
    block = ranked._Block()
    for i, text in enumerate(texts):
        counted = Counter(terms(text))
        block.ids.append(i)
        block.lengths.append(counted.total())
        block.tallies.add(counted)
    names = [x.split()[0] for x in ranked.INDEX.split(", ")]
    searched = ranked._Searched(dict(zip(names, block.row(9), strict=True)), 50, 5000)
    for text in texts[:10]:
        asked = sorted(set(terms(text)))
        item = ranked.Item(0, 0, asked, np.arange(1, len(asked) + 1))
        bounds = searched.bounds(item, ranked.hashes(asked))
        assert (bounds >= searched.scores(item, np.arange(50))).all()


def test_long_texts_are_cut_at_gaps(monkeypatch):
    text = "Ab ab,é É\x00x " * 50
    find, gap = re.compile(ranked.TERM).findall, re.compile(ranked.GAP)
    whole = ranked.counted_terms(text, find, gap)
    monkeypatch.setattr(tallies, "LONG_TEXT", 5)
    assert ranked.counted_terms(text, find, gap) == whole == Counter(terms(text))


@pytest.mark.parametrize("rows", [[{}], [{"a": 3}, {}, {"b": 1, "a": 2}, {"c": 70000}]])
def test_tallies_round_trip(rows):
    held = tallies.Tallies()
    for row in rows:
        held.add(row)
    words, holders, packed = held.packed()
    cuts, refs, counts = tallies.unpacked(packed, len(rows), len(held.refs))
    found = [{words[r]: c for r, c in zip(refs[a:b], counts[a:b], strict=True)} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert found == rows
    assert dict(zip(words, holders.tolist(), strict=True)) == dict(Counter(w for row in rows for w in row))


def test_given_documents(spark, data_folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{data_folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{data_folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert plain(queries.op12_ranked_search(spark, data_folder)) == expected(docs, items)
