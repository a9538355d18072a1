import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shiftledger.llm import queries
from shiftledger.llm.packing import pack, piece_lengths, read_buckets, write_buckets

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World! It's 12 o'clock", "", None, "   \t\n ", "café café ́x e ́", "ΣΑΣ ΑΣ Σ",
    "<|startoftext|> a<|endoftext|>b x<|startoftext|>y", "a b c", "wor" * 3000, "one two " * 9000, "한국어 中文 \U0001f600!",
    "x" * 700 + " " + "x" * 701, "don't we'll I'M İ \x00 a\x0bb\x1cc\x85d",
]


def test_piece_lengths():
    assert piece_lengths(1) == [1] and piece_lengths(0) == []
    assert piece_lengths(4096 + 5) == [2048, 2048, 4, 1]
    assert all(sum(piece_lengths(n)) == n for n in range(5000))


def test_ids_are_those_of_the_whole_text(spark):
    direct = Tokenizer.from_file(PATH)
    rows = [(i % 13 if i != 5 else None, t) for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    found = sorted(pack(docs, PATH).collect(), key=lambda r: r.sequence_id)
    whole = sorted(tuple(direct.encode(t or "", add_special_tokens=False).ids) + (1,) for _, t in rows)
    joined, current = [], []
    for r in found:
        assert r.length == len(r.ids) and r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.start == 0:
            current = []
        assert r.start == len(current)
        current = current + list(r.ids)
        if len(current) == r.doc_tokens:
            joined.append(tuple(current))
    assert sorted(joined) == whole
    assert len({r.sequence_id for r in found}) == len(found)


def test_given_documents(spark, data_folder):
    docs = spark.read.parquet(f"{data_folder}/documents.parquet")
    direct = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in pack(docs, PATH).filter("start = 0").collect():
        ids = [*direct.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert r.doc_tokens == len(ids) and list(r.ids) == ids[: r.length]


def test_empty_table_and_buckets(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pack(none, PATH).collect() == []
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, length string")
    write_buckets(pack(docs, PATH), str(tmp_path / "buckets"))
    assert [r.length for r in spark.read.parquet(str(tmp_path / "buckets")).collect()] == [4]


def test_the_query_and_the_pipeline_return_the_ids(spark, data_folder):
    direct = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{data_folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    packed = corpus_pipeline.packed(spark, docs, data_folder)
    for found in (queries.op7_packing(spark, data_folder), packed):
        assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        assert found.schema.fields[2].dataType.simpleString() == "bigint"
        rows = found.collect()
        assert {r.doc_id for r in rows} == set(texts) and len({r.sequence_id for r in rows}) == len(rows)
        for r in rows:
            ids = [*direct.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
            assert list(r.ids) == ids[r.start : r.start + r.length] and len(r.ids) == r.length
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    lengths = {}
    for r in packed.select("length", "_metadata.file_path").distinct().collect():
        assert lengths.setdefault(r.file_path, r.length) == r.length and f"/length={r.length}/" in r.file_path
    assert corpus_pipeline.packed(spark, docs.limit(0), data_folder).collect() == []


def test_buckets_are_read_as_they_were_packed(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    pieces = pack(docs, PATH)
    write_buckets(pieces, str(tmp_path / "some"))
    found = read_buckets(spark, str(tmp_path / "some"))
    assert found.dtypes == pieces.dtypes and sorted(found.collect()) == sorted(pieces.collect())
