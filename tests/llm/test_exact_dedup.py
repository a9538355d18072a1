import hashlib
import random

import numpy as np
import pytest

from shiftledger.llm.exact_dedup import CuckooIndex, digests, drop_exact_copies, exact_copies, live_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def keys(n, seed=0):
    return np.frombuffer(b"".join(hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)


def test_index_grows_finds_and_deletes():
    index, held = CuckooIndex(buckets=2), keys(20_000)
    for at in range(0, len(held), 3_000):
        index.insert(held[at : at + 3_000])
    assert index.growths >= 8
    assert (index.find(held) == np.arange(len(held))).all()
    assert (index.find(keys(20_000, seed=1)) < 0).all()
    gone = index.delete(held[::3])
    assert (gone == np.arange(0, len(held), 3)).all()
    assert (index.find(held[::3]) < 0).all()
    left = np.setdiff1d(np.arange(len(held)), gone)
    assert (index.find(held[left]) == left).all()
    assert (index.delete(held[:1]) < 0).all()
    again = index.insert(held[::3])
    assert (index.find(held[::3]) == again).all()


def test_equal_prints_are_told_apart_by_the_stored_key():
    held = keys(400).copy()
    held[:, :16] = held[0, :16]  # same buckets, same fingerprint
    index = CuckooIndex(buckets=256)
    index.insert(held[:8])
    assert (index.find(held[:8]) == np.arange(8)).all()
    assert (index.find(held[8:]) < 0).all()


def expected(rows):
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for row in rows:
        groups.setdefault(norm(row[1]), []).append(row[0])
    low = lambda i: (i is not None, i or 0)
    return {t: (max(ids, key=low), len(ids)) for t, ids in groups.items()}, norm


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = ["", None, "A b", "a B", "É", "é", "a b ", "x" * 200_000, "X" * 200_000, "İstanbul", "line\nline"]
    made = [(i, rng.choice(texts), "en", None, 1) for i in range(300)]
    return [*made, (None, "A b", None, None, None), (None, "only null", None, None, None), (299, made[299][1], "en", None, 1)]


def test_groups_match_a_dictionary(spark, rows):
    groups, norm = expected(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = exact_copies(docs).collect()
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    assert all((r.keep_id, r.group_size) == by_digest[r.text_sha256] for r in found)
    assert sum(r.kept for r in found) == len(groups)
    stay = drop_exact_copies(docs)
    assert stay.columns == docs.columns
    assert sorted((norm(r.text), (r.doc_id is not None, r.doc_id or 0)) for r in stay.collect()) == sorted(
        (t, (i is not None, i or 0)) for t, (i, _) in groups.items()
    )


def test_withdrawn_digests_leave_the_index(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    gone = hashlib.sha256(b"a b").digest()
    withdrawn = spark.createDataFrame([(bytearray(gone),), (bytearray(32),)], "digest binary")
    left = {bytes(r.digest) for r in live_groups(digests(docs), withdrawn).collect()}
    assert gone not in left and len(left) == len(expected(rows)[0]) - 1
    assert not any(r.kept for r in exact_copies(docs, withdrawn=withdrawn).collect() if r.text_sha256 == gone.hex())


def test_empty_table_and_clashing_columns(spark):
    assert exact_copies(spark.createDataFrame([], SCHEMA)).collect() == []
    assert drop_exact_copies(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "a", b"x", 7, 0), (2, "A", b"y", 8, 1)], "doc_id long, text string, digest binary, keep_id long, n long")
    assert [tuple(r) for r in drop_exact_copies(docs).collect()] == [(2, "A", bytearray(b"y"), 8, 1)]
    assert {r.doc_id: r.kept for r in exact_copies(docs).collect()} == {1: False, 2: True}
