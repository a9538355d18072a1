"""The registered queries against their SQL, and the pipeline against a plain version."""

import zlib
from collections import Counter, defaultdict

import pytest
from comparison import differences, duckdb_connection
from small import lowered, words
from test_mixing import targets
from test_near_join import expected

import corpus_pipeline
from shiftledger.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_the_sql(spark, data_folder, name):
    found = differences(spark, queries.QUERIES[name], queries.ORACLES[name], data_folder, duckdb_connection(data_folder))
    assert not found, found


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_one_row_per_document(spark, data_folder, name):
    if name in ("op7_packing", "op8_chat", "op12_ranked_search"):
        pytest.skip("rows of another kind")
    docs = spark.read.parquet(f"{data_folder}/documents.parquet")
    assert Counter(r.doc_id for r in queries.QUERIES[name](spark, data_folder).select("doc_id").collect()) == Counter(
        r.doc_id for r in docs.select("doc_id").collect()
    )


def test_pipeline_matches_a_plain_version(spark, data_folder):
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in spark.read.parquet(f"{data_folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    good = {r.doc_id for r in queries.op3_quality(spark, data_folder).collect() if r.predicted}
    kept = [r for r in rows if r[0] in good]
    last = {}
    for r in sorted(kept):
        last[lowered(r[1])] = r
    kept = list(last.values())
    classes = set(expected(kept)[1])
    kept = [r for r in kept if r[0] in classes]
    sizes = Counter()
    for r in kept:
        sizes[r[3]] += len(words(r[1]))
    goals, most = targets(sizes), defaultdict(int)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())

    found = corpus_pipeline.run(spark, data_folder).collect()
    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["exact dedup", "n-gram Jaccard join"]
    assert {r.doc_id for r in found} <= classes
    copies = Counter(r.doc_id for r in found if r.start == 0)
    taken = Counter()
    for r in kept:
        size = len(words(r[1]))
        assert copies[r[0]] <= 3
        taken[r[3]] += copies[r[0]] * size
        most[r[3]] = max(most[r[3]], size)
    assert all(abs(taken[s] - goals[s]) <= most[s] / 2 + 1 for s in goals)
    texts = {r[0]: r[1] for r in kept}
    for r in found:
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        piece = ids[r.start : r.start + r.length]
        assert r.doc_tokens == len(ids) and len(piece) == r.length
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece))
    assert all(n == copies[i] * len({r.start for r in found if r.doc_id == i}) for i, n in Counter(r.doc_id for r in found).items())


def test_stages_return_the_columns_of_documents(spark, data_folder):
    docs = spark.read.parquet(f"{data_folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), data_folder).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), data_folder).collect() == []
