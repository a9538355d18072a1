from collections import Counter, defaultdict

import pytest
from small import DOCS, awkward_rows, prose, words

from shiftledger.llm.mixing import MOST_COPIES, mixed, with_copies


def targets(sizes, weights=(5, 2, 1)):
    """Shares by weight; what passes three times a source's size is shared again until none does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: 3 * sizes[s] for s in over}


@pytest.fixture(scope="module")
def rows():
    import random

    rng = random.Random(2)
    made = awkward_rows()
    for i in range(900):
        source = rng.choice(["hot"] * 6 + ["a", "b", "é", "z", "tiny", None])
        if source != "tiny" or rng.random() < 0.1:
            made.append((1000 + i, prose(rng, rng.choice([3, 20, 60, 200])), "en", source, 1))
    return made


def test_targets_and_taken_words(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    found = with_copies(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.mix_size == len(words(r.text)) and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(want[r.source])
        assert 0 <= r.mix_copies <= MOST_COPIES
        taken[r.source] += r.mix_copies * r.mix_size
        largest[r.source] = max(largest[r.source], r.mix_size)
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= largest[source] / 2 + 1
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_and_copies_are_returned(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    one = Counter((r.doc_id, r.text, r.mix_copies) for r in with_copies(docs.repartition(3)).collect())
    assert one == Counter((r.doc_id, r.text, r.mix_copies) for r in with_copies(docs.repartition(7)).collect())
    held = mixed(docs)
    assert held.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in held.collect()) == Counter({(i, t): 0 for i, t, _ in one}) + Counter(
        x for (i, t, n), times in one.items() for x in [(i, t)] * (n * times)
    )


def test_short_documents_are_taken_less(spark):
    import random

    rng = random.Random(5)
    made = [(i, prose(rng, 20 if i % 2 else 100), "en", "ab"[i % 20 == 0], 1) for i in range(2000)]
    found = with_copies(spark.createDataFrame(made, DOCS)).filter("source = 'a'").collect()
    means = [sum(r.mix_copies for r in found if (r.mix_size == n)) / sum(r.mix_size == n for r in found) for n in (20, 100)]
    assert means[0] == pytest.approx(means[1] / 2, rel=0.1)


def test_clashing_columns(spark):
    made = [(i, "w " * (60 + i % 7), "ab"[i % 2], "t", i, i, 0) for i in range(50)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, target string, copies long, mix_size long, bin long")
    held = mixed(docs)
    assert held.columns == docs.columns and {(r.target, r.copies == r.mix_size) for r in held.collect()} == {("t", True)}
    plain = docs.drop("mix_size")
    assert with_copies(plain).columns == [*plain.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    assert with_copies(plain).filter("target = 't'").count() == 50


def test_repeated_rows_and_no_rows(spark):
    made = [(5, "w " * 100, "en", "a", 1)] * 60 + [(i, "w " * 100, "en", "b", 1) for i in range(40)]
    found = with_copies(spark.createDataFrame(made, DOCS)).collect()
    for source in "ab":
        goal = next(r.mix_target for r in found if r.source == source)
        assert abs(sum(r.mix_copies * r.mix_size for r in found if r.source == source) - goal) <= 51
    empty = spark.createDataFrame([], DOCS)
    assert with_copies(empty).collect() == [] and mixed(empty).collect() == []
    assert [r.mix_copies for r in with_copies(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()] == [0]
