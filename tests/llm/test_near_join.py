import random
from collections import defaultdict

import numpy as np
import pytest
from small import DOCS, awkward_rows, lowered, prose, words

from shiftledger.llm import near_join
from shiftledger.llm.components import components
from shiftledger.llm.near_join import bands_and_rows, count_links, drop_near_copies, near_copies


def grams(text):
    held = words(lowered(text))
    return frozenset(tuple(held[i : i + 5]) for i in range(max(len(held) - 4, 1))) if held else frozenset()


def jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def expected(rows, similarity=0.8):
    """{row number: (class id, links)} by comparing all pairs."""
    sets = [grams(r[1]) for r in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= similarity:
                links[i] += 1
                links[j] += 1
                top[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(rows[i][0], ids[find(i)], links[i]) for i in range(len(rows))], list(ids.values())


def changed(rng, text, share):
    held = text.split(" ")
    for i in rng.sample(range(len(held)), max(1, int(len(held) * share))):
        held[i] = "zz" + str(rng.randint(0, 9))
    return " ".join(held)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = awkward_rows()
    for group in range(25):
        base = prose(rng, rng.choice([4, 12, 80, 300]))
        for _ in range(rng.randint(1, 9)):
            made.append((100 + len(made), changed(rng, base, rng.choice([0.0, 0.01, 0.03, 0.1])), "en", "a", 1))
        made.append((100 + len(made), base.title(), "en", "a", 1))
    return made


def order(x):
    return tuple((v is not None, v or 0) for v in x)


def test_classes_and_links_match_all_pairs(spark, rows):
    want, classes = expected(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = [(r.doc_id, r.class_id, r.n_links) for r in near_copies(docs).collect()]
    assert sorted(found, key=order) == sorted(want, key=order)
    stay = drop_near_copies(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id for r in stay.collect()), key=lambda x: (x is not None, x or 0)) == sorted(
        classes, key=lambda x: (x is not None, x or 0)
    )


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    """A group of many near copies and a third of all rows, in blocks of a few."""
    rng = random.Random(9)
    base = prose(rng, 120)
    made = [(i, changed(rng, base, 0.01), "en", "a", 1) for i in range(150)]
    made += [(1000 + i, base, "en", "a", 1) for i in range(150)] + [(2000 + i, prose(rng, 50), "en", "b", 1) for i in range(50)]
    monkeypatch.setattr(near_join, "BLOCK_NODES", 40)
    monkeypatch.setattr(near_join, "STRIP", 16)
    found = [(r.doc_id, r.class_id, r.n_links) for r in near_copies(spark.createDataFrame(made, DOCS)).collect()]
    assert sorted(found) == sorted(expected(made)[0])


def test_a_full_filter_changes_no_result(spark, rows, monkeypatch):
    """With one piece of the filter for all ids most texts pass wrongly, and the join drops them."""
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = sorted([tuple(r) for r in near_copies(docs).collect()], key=order)
    monkeypatch.setattr(near_join, "FILTER_BITS", 64)
    assert sorted([tuple(r) for r in near_copies(docs).collect()], key=order) == want


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.9995), (0.9, 0.99), (0.8, 0.9)):
        bands, rows = bands_and_rows(similarity, recall)
        assert bands * rows <= 256
        assert 1 - (1 - similarity**rows) ** bands >= recall
    with pytest.raises(ValueError):
        bands_and_rows(0.01, 0.9999)


def test_count_links_across_and_within():
    rng = random.Random(2)
    sets = [np.unique(np.array(rng.sample(range(60), 40), np.uint64)) for _ in range(30)]
    copies = np.array([rng.randint(1, 4) for _ in sets])
    near = lambda i, j: jaccard(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.6
    for block in (np.zeros(30, int), np.ones(30, int), np.arange(30) % 2):
        links, _ = count_links(sets, copies, block, 0.6)
        across = len(set(block.tolist())) == 2
        for i in range(30):
            others = [j for j in range(30) if j != i and (not across or block[i] != block[j]) and near(i, j)]
            assert links[i] == sum(copies[j] for j in others)


def test_components_match_a_union(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5000, i) for i in range(5001, 5300)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        top[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: find(x) for u, v in edges if u != v for x in (u, v)}


def test_empty_table_and_clashing_columns(spark):
    assert near_copies(spark.createDataFrame([], DOCS)).collect() == []
    assert drop_near_copies(spark.createDataFrame([], DOCS)).collect() == []
    docs = spark.createDataFrame([(1, "a b c d e f", 5, 6), (2, "A b c d e f", 7, 8)], "doc_id long, text string, h1 long, root long")
    assert [tuple(r) for r in drop_near_copies(docs).collect()] == [(1, "a b c d e f", 5, 6)]
    assert {(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in near_copies(docs).collect()} == {(1, 1, 1, 2), (2, 1, 1, 2)}
