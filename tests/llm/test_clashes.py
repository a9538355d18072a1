"""Documents with awkward rows and with columns named like anything inside the operators and stages."""

import pytest
from small import DOCS, awkward_rows

import corpus_pipeline
from shiftledger.llm import pii, queries
from shiftledger.llm.exact_dedup import exact_copies
from shiftledger.llm.host_rules import judge
from shiftledger.llm.mixing import with_copies
from shiftledger.llm.near_join import near_copies
from shiftledger.llm.packing import pack
from shiftledger.llm.quality import quality_scores
from shiftledger.llm.secrets import digest, find_secrets
from shiftledger.llm.token_counts import token_counts
from shiftledger.llm.toxicity import toxic_passages

CLASHES = (
    "the score", "the text", "score", "label", "held", "key", "row key", "near id", "near h1", "h1", "h2", "id", "node", "root", "links",
    "digest", "keep_id", "row_uid", "n_entities", "pii_row", "size", "rank", "bin", "copies", "target", "word", "block", "tree", "position",
    "predicted", "n_words", "kept", "spans", "length", "ids", "quality", "toxic", "class_id", "held_out", "passages", "evidence",
)


@pytest.fixture(scope="module")
def tables(spark):
    rows = awkward_rows() + awkward_rows()[-3:]
    plain = spark.createDataFrame(rows, DOCS)
    extra = spark.createDataFrame(
        [(*r, *(f"{c} {i}" for c in CLASHES)) for i, r in enumerate(rows)], DOCS + "".join(f", `{c}` string" for c in CLASHES)
    )
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 10)], "doc_id long, quality int, toxic int")
    return plain, extra, labels


OPERATORS = {
    "near": lambda docs, labels: near_copies(docs),
    "toxicity": lambda docs, labels: toxic_passages(docs, labels),
    "quality": lambda docs, labels: quality_scores(docs, labels),
    "exact": lambda docs, labels: exact_copies(docs),
    "secrets": lambda docs, labels: digest(find_secrets(docs)),
    "packing": lambda docs, labels: pack(docs, queries.tokenizer_path()).drop("sequence_id"),
    "mixing": lambda docs, labels: with_copies(docs).select("doc_id", "mix_size", "mix_target"),
    "host rules": lambda docs, labels: judge(docs),
    "tokens": lambda docs, labels: token_counts(docs, queries.tokenizer_path("byte_bpe_50k.json")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_give_the_same_rows(tables, name):
    plain, extra, labels = tables
    columns = OPERATORS[name](plain, labels).columns
    found, want = (sorted(map(str, OPERATORS[name](d, labels).select(*columns).collect())) for d in (extra, plain))
    assert found == want and want


def test_surrogates_keep_a_column_of_their_counts_name(tables):
    _, extra, _ = tables
    found = pii.with_surrogates(extra, "key")
    assert found.columns == [*extra.columns, "n_entities_"]
    assert sorted(r["n_entities"] for r in found.collect()) == sorted(r["n_entities"] for r in extra.collect())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_all_columns(spark, tables, name, tmp_path):
    plain, extra, labels = tables
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    want = sorted(map(str, stage(spark, plain, str(tmp_path)).collect()))
    kept = stage(spark, extra, str(tmp_path))
    assert kept.dtypes == extra.dtypes
    rows = kept.collect()
    assert sorted(map(str, kept.select(*plain.columns).collect())) == want
    given = {tuple(r) for r in extra.collect()}
    assert all(tuple(r) in given for r in rows)
