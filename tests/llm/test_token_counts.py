import pytest
from small import DOCS, awkward_rows

from shiftledger.llm import queries, tallies
from shiftledger.llm.token_counts import SETTLED, PreTokenizer, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Hello, World! It's 12 o'clock", "", None, "   \t\n ", "a\n\n b  c\n", "<|endoftext|>", "x <|endoftext|><|endoftext|>  y<|endo",
    "don't we'll I'M 'tis ''ll", "한국어 中文 \U0001f600! ՘꟎ a", "a\x1cb\x85c  d　 e", "wor" * 4000,
    "12 345² ½ Ⅷ ٣", "\x00\x01 nul", "naïve café é", "\U00013455 \U0001e900",
]


def direct():
    return tokenizers.Tokenizer.from_file(PATH)


def test_counts_are_those_of_the_tokenizer(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[0]), (3, TEXTS[0])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, block long")
    one = direct()
    expected = sorted(
        ((i, len((t or "").encode()), n, n > 10) for i, t in rows for n in [len(one.encode(t or "", add_special_tokens=False).ids)]),
        key=str,
    )
    for block_rows, entries in ((4096, 1_000_000), (2, 3)):
        found = token_counts(docs.repartition(2), PATH, limit=10, block_rows=block_rows, block_entries=entries).collect()
        assert sorted((tuple(r) for r in found), key=str) == expected


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    one, counted = direct(), PreTokenizer(PATH)
    text = "\n".join(t or "" for t in TEXTS) * 3 + " plain words and no more" * 50
    whole = counted(text)
    monkeypatch.setattr(tallies, "LONG_TEXT", 20)
    assert len(list(tallies.parts(text, counted.border))) > 50
    assert counted(text) == whole
    assert sum(len(one.encode(w, add_special_tokens=False).ids) * n for w, n in whole[0].items()) + whole[1] == len(
        one.encode(text, add_special_tokens=False).ids
    )


def test_settled_characters_are_cut_alike():
    counted = PreTokenizer(PATH)
    for low in range(0, 0x10000, 256):
        for c in map(chr, range(low, low + 256)):
            if not 0xD800 <= ord(c) < 0xE000 and counted.settled(c):
                text = f"a{c}1{c} {c}!{c}{c}"
                assert counted.find(text) == [text[x:y] for _, (x, y) in counted.cut(text)], hex(ord(c))
    assert not counted.settled("՘") and SETTLED


def test_awkward_rows_and_an_empty_table(spark):
    rows = awkward_rows()
    one = direct()
    found = token_counts(spark.createDataFrame(rows, DOCS), PATH).collect()
    expected = [(r[0], len((r[1] or "").encode()), len(one.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=str) == sorted(expected, key=str)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)
    assert token_counts(spark.createDataFrame([], DOCS), PATH).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        PreTokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_given_documents(spark, data_folder):
    one = direct()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data_folder}/documents.parquet").collect()}
    found = queries.op13_token_counts(spark, data_folder).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(one.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len((texts[r.doc_id] or "").encode()))
