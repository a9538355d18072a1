import random
from collections import Counter

import pytest
from small import DOCS, awkward_rows, prose, words

from shiftledger.llm.host_rules import host_verdicts, judge, measures


def plain(text):
    text = text or ""
    held = words(text)
    windows = [tuple(held[i : i + 3]) for i in range(len(held) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(held), sum(map(len, held)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = awkward_rows()
    for i in range(200):
        bad = i % 4 == 0
        host = "bad.example" if bad or i % 20 == 1 else rng.choice(["good.example", "fine.example", "small.example"])
        text = prose(rng, 90) if not bad else prose(rng, 60).replace(" ", "# ")
        made.append((1000 + i, text, "en", host, 1))
    made += [(2000, "a b a b a b a b", "", "rep", 1), (2001, "x y z x y z\r\nx y z", "", "rep", 1), (2002, "p q r\n\np q r\n \n p q r", "", "rep", 1)]
    return made


def test_measures_match_plain_counts(spark, rows):
    found = judge(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    key = lambda x: (x[0] is not None, *[v or 0 for v in x])
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found]
    assert sorted(got, key=key) == sorted([(r[0], *plain(r[1])) for r in rows], key=key)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.host_failed)


def test_bad_hosts_take_their_documents_with_them(spark, rows):
    found = {r.doc_id: r for r in judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert not found[1001].base_failed and found[1001].host_failed and not found[1001].kept  # clean, on the bad host
    clean = [r for i, r in found.items() if i and 1000 <= i < 1200 and i % 4 and i % 20 != 1]
    assert all(r.kept for r in clean)


def test_rates_are_shrunk(spark):
    rows = [(i, "x", 60, 0, 20 if i < 1 else 0, 1, 0) for i in range(400)]
    schema = "id long, host string, n_words long, n_repeat_words long, n_symbols long, n_lines long, n_dup_lines long"
    hosts = [(i, "one" if i == 0 else f"h{i % 4}", *r[2:]) for i, r in enumerate(rows)]
    found = {r.host: r for r in host_verdicts(spark.createDataFrame(hosts, schema)).collect()}
    assert found["one"].symbols_rate < 0.7 and found["one"].n_docs == 1
    assert not found["h1"].host_failed
    assert all(0 <= r.symbols_rate <= 1 for r in found.values())


def test_empty_table_and_clashing_columns(spark):
    assert judge(spark.createDataFrame([], DOCS)).collect() == []
    docs = spark.createDataFrame([(1, "a b", "h", 9, "k")], "doc_id long, text string, source string, n_words long, host string")
    row = judge(docs).collect()[0]
    assert (row.doc_id, row.n_words, row.base_failed, row.kept) == (1, 2, True, False)
    assert measures(docs).select("n_words").collect()[0][0] == 2
