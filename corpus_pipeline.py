"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, data folder) and works on all rows that its predecessor kept. All but the
last return the columns of ``documents``; the last returns the packed sequences with their token ids, from buckets of one length each.
SQL cannot express the classifier, so there is no ORACLE_SQL; a brute-force version is in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftledger.llm.exact_dedup import drop_exact_copies
from shiftledger.llm.mixing import mixed
from shiftledger.llm.near_join import drop_near_copies
from shiftledger.llm.packing import pack, read_buckets, write_buckets
from shiftledger.llm.quality import keep_good
from shiftledger.llm.queries import table, tokenizer_path
from shiftledger.session import new_folder

CACHE_IDS = 2_000_000  # a third of the usual table of known chunks: the executors also hold what earlier stages left


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return keep_good(docs, table(spark, folder, "labels"))


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    buckets = new_folder(spark, "buckets")
    write_buckets(pack(docs, tokenizer_path(), cache_ids=CACHE_IDS), buckets)
    return read_buckets(spark, buckets)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` to packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
