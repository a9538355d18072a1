import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from small import DOCS, awkward_rows

from shiftledger.llm import midstates
from shiftledger.llm.manifest import as_hex, tree_key, verified_documents, write_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return h(*map(field, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def levels(digests, fanout):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + fanout]) for i in range(0, len(found[-1]), fanout)])
    return found


def path(tree, at, fanout, digest):
    met = []
    for nodes in tree[:-1]:
        low = at // fanout * fanout
        run = nodes[low : low + fanout]
        run[at - low] = digest
        met += [x for i, x in enumerate(run) if i != at - low]
        digest, at = h(*run), at // fanout
    return digest, met


def expected(rows, fanout=2):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    built = {n: levels([leaf_of(r) for r in trees[n]], fanout) for n in names}
    forest = levels([built[n][-1][0] for n in names], fanout)
    root = forest[-1][0] if names else None
    for i, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            digest, met = path(built[name], at, fanout, leaf_of(row, int(tampered)))
            digest, more = path(forest, i, fanout, digest)
            yield row[0], leaf_of(row), built[name][-1][0], root, h(*met, *more), digest, digest == root


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def random_rows(count, seed):
    rng = random.Random(seed)
    return [(i, f"text {i}", rng.choice(["en"] * 8 + ["fr", "é", "", None]), "s", rng.choice([None, i])) for i in range(count)]


def test_resumed_states_give_the_standard_digests():
    rng = np.random.default_rng(3)
    digests = rng.integers(0, 256, (9000, 32), dtype=np.uint8)
    state = midstates.absorb_digests(midstates.start(9000), digests)
    kept = midstates.bytes_to_words(midstates.words_to_bytes(state))
    assert (kept == state).all()
    both = midstates.finish(midstates.absorb_digests(kept, digests[::-1]), np.full(9000, 2))
    for at in (0, 1, 4500, 8999):
        first, second = bytes(digests[at]).hex(), bytes(digests[8999 - at]).hex()
        assert bytes(both[at]).hex() == h(first, second)
    assert bytes(midstates.finish(midstates.start(1), np.zeros(1))[0]).hex() == h()


@pytest.mark.parametrize(("count", "fanout", "height"), [(1, 2, 1), (37, 2, 1), (64, 2, 2), (150, 3, 2), (90, 2, 12)])
def test_same_as_a_plain_tree(spark, count, fanout, height):
    rows = random_rows(count, count)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert plain(verified_documents(docs, tampered(), fanout=fanout, height=height).collect()) == plain(expected(rows, fanout))


def test_awkward_rows_and_clashing_names(spark):
    rows = awkward_rows() + awkward_rows()[:4]
    docs = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], DOCS + ", position long, tree string, digest string, block int")
    assert plain(verified_documents(docs, tampered(), height=2).collect()) == plain(expected(rows))
    assert verified_documents(spark.createDataFrame([], DOCS), tampered()).collect() == []


def test_the_manifest_folds_any_replacement(spark):
    rows = [(i, "t") for i in range(30)]
    leaves = spark.createDataFrame(rows, "doc_id long, name string").select(
        tree_key(F.lit(None)).alias("tree"), F.unhex(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256)).alias("digest"), "doc_id"
    )
    manifest = write_manifest(leaves, ["doc_id"], fanout=3, height=2)
    replaced = manifest.leaves.filter("doc_id in (4, 29)").select(
        "tree", "position", F.unhex(F.sha2(F.lit("new").cast("binary"), 256)).alias("digest"), "doc_id"
    )
    tree = levels([h(str(i)) for i in range(30)], 3)
    found = {r.doc_id: r for r in manifest.fold(replaced).withColumn("folded", as_hex("folded")).withColumn("root", as_hex("root")).collect()}
    assert {i: r.folded for i, r in found.items()} == {i: path(tree, i, 3, h("new"))[0] for i in (4, 29)}
    assert {r.root for r in found.values()} == {tree[-1][0]}
    with pytest.raises(ValueError, match="fanout"):
        write_manifest(leaves, ["doc_id"], fanout=1)
