"""Labelled rows for training, and the part of them held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for the ids (about a fifth) whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, *, text: str, doc_id: str) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled ids that are not held out.

    With more labelled ids than that, those with the smallest hashes are taken. An id
    with several labels has the largest of them; null labels and ids count for nothing.
    Only the ids and labels of the bounded sample are broadcast.
    """
    chosen = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
