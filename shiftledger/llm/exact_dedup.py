"""Exact deduplication over a cuckoo-filter index that is sharded by digest.

Texts are equal when they are identical after lower-casing A-Z. Each text gets
the SHA-256 of that form. Spark deals digests out by hash; every task holds the
cuckoo filter of its shard: two candidate buckets of four 16-bit fingerprints for
each digest, and beside each fingerprint the place of the stored key. A filter hit
is verified against the stored full digest, so a false positive costs one
comparison and never a wrong answer. When an insertion finds no room, the table
doubles and is refilled from the stored keys. Copies within one batch are merged
before the shuffle, so a digest of a third of all rows sends one row per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.blocks import bytes_of, lowered, mix
from shiftledger.session import new_folder

SLOTS = 4
KICKS = 60  # rounds of moving entries before the table grows
ENTRY = "digest binary, doc_id long, row_uid long, n long, withdrawn boolean"
GROUP = "digest binary, keep_id long, keep_uid long, group_size long"


class CuckooIndex:
    """Live digests of one shard, with batch insertion, lookup and deletion."""

    def __init__(self, buckets: int = 256) -> None:
        self.keys = np.zeros((1024, 32), np.uint8)
        self.used = 0
        self.unsettled = np.zeros(0, np.int64)  # entries that the last insertion found no slot for
        self.growths = 0
        self._table(buckets)

    def _table(self, buckets: int) -> None:
        self.mask = np.uint64(buckets - 1)
        self.prints = np.zeros((buckets, SLOTS), np.uint16)
        self.places = np.full((buckets, SLOTS), -1, np.int64)

    def _home(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 4)
        prints = (words[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1  # zero marks a free slot
        first = words[:, 0] & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64)) & self.mask)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each live key, -1 where it is absent."""
        found = np.full(len(keys), -1, np.int64)
        prints, first, second = self._home(keys)
        for bucket in (first, second):
            for slot in range(SLOTS):
                hit = np.flatnonzero((self.prints[bucket, slot] == prints) & (found < 0))
                place = self.places[bucket[hit], slot]
                same = (self.keys[place] == keys[hit]).all(axis=1)
                found[hit[same]] = place[same]
        return found

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """Stores keys that are distinct and not live; returns their places."""
        places = np.arange(self.used, self.used + len(keys))
        while self.used + len(keys) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)])
        self.keys[places] = keys
        self.used += len(keys)
        live = int((self.places >= 0).sum())
        if (live + len(keys)) * 10 > self.places.size * 9 or not self._settle(places):
            self._grow(live + len(keys), places)
        return places

    def _settle(self, places: np.ndarray) -> bool:
        """Puts entries into free slots, moving others along; False when some are left over."""
        self.unsettled = places[:0]
        places = places.copy()
        prints, bucket, other = self._home(self.keys[places])
        for turn in range(KICKS):
            for side in (0, 1):
                for slot in range(SLOTS):
                    at = other if side else bucket
                    free = np.flatnonzero(self.prints[at, slot] == 0)
                    _, one = np.unique(at[free], return_index=True)
                    take = free[one]
                    self.prints[at[take], slot], self.places[at[take], slot] = prints[take], places[take]
                    left = np.ones(len(places), bool)
                    left[take] = False
                    places, prints, bucket, other = places[left], prints[left], bucket[left], other[left]
                    if not len(places):
                        return True
            _, one = np.unique(bucket, return_index=True)  # one entry per bucket pushes another out
            home, slot = bucket[one], (turn + places[one]) % SLOTS
            pushed, pushed_print = self.places[home, slot], self.prints[home, slot]
            self.places[home, slot], self.prints[home, slot] = places[one], prints[one]
            places[one], prints[one] = pushed, pushed_print
            bucket[one], other[one] = self._other(home, pushed_print), home
        self.unsettled = places
        return False

    def _grow(self, live: int, added: np.ndarray) -> None:
        """Doubles the table until all live keys fit, refilling it from the stored keys."""
        held = np.union1d(np.union1d(self.places[self.places >= 0], added), self.unsettled)
        buckets = self.places.shape[0]
        while True:
            buckets *= 2
            self.growths += 1
            if live * 10 <= buckets * SLOTS * 9:
                self._table(buckets)
                if self._settle(held):
                    return

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """Removes live keys; returns the places they had, -1 where a key was absent."""
        found = self.find(keys)
        for bucket in self._home(keys)[1:]:
            for slot in range(SLOTS):
                hit = np.flatnonzero((self.places[bucket, slot] == found) & (found >= 0))
                self.places[bucket[hit], slot] = -1
                self.prints[bucket[hit], slot] = 0
        return found


def _digest_rows(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = bytes_of(batch.column(batch.schema.get_field_index(text)))
        view = memoryview(lowered(data))
        digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        rest = [i for i, name in enumerate(batch.schema.names) if name != text]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in rest), pa.array(digests, pa.binary())],
            [*(batch.schema.names[i] for i in rest), "digest"],
        )


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row_uid, digest) for each row."""
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_uid"),
        docs[text].cast("string").alias("text"),
    )
    return rows.mapInArrow(
        lambda batches: _digest_rows(batches, "text"), "doc_id long, row_uid long, digest binary"
    )


def _last_of_each(codes: np.ndarray, ids: np.ndarray, known: np.ndarray, uids: np.ndarray) -> np.ndarray:
    """Of equal codes, the row with the largest id (null lowest), then the largest uid."""
    order = np.lexsort((uids, ids, known, codes))
    ends = np.flatnonzero(np.diff(codes[order], append=-1))
    return order[ends]


def _columns(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("doc_id")
    return (
        batch.column("digest"),
        ids.fill_null(0).to_numpy(zero_copy_only=False),
        ids.is_valid().to_numpy(zero_copy_only=False),
        batch.column("row_uid").to_numpy(zero_copy_only=False),
    )


def _merge_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, ids, known, uids = _columns(batch)
        coded = held.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        last = _last_of_each(codes, ids, known, uids)
        counts = np.bincount(codes)
        yield pa.RecordBatch.from_arrays([
            coded.dictionary.take(pa.array(codes[last])), pa.array(ids[last], mask=~known[last]),
            pa.array(uids[last]), pa.array(counts[codes[last]].astype(np.int64)),
            pa.array(np.zeros(len(last), bool)),
        ], ["digest", "doc_id", "row_uid", "n", "withdrawn"])


def _run_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    ids, known, uids, sizes = (np.zeros(0, kind) for kind in (np.int64, bool, np.int64, np.int64))
    gone: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
        out = batch.column("withdrawn").to_numpy(zero_copy_only=False)
        if out.any():
            gone.append(keys[out])
        batch, keys = batch.filter(pa.array(~out)), keys[~out]
        held, new_ids, new_known, new_uids = _columns(batch)
        codes = held.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(codes, weights=batch.column("n").to_numpy(zero_copy_only=False))
        last = _last_of_each(codes, new_ids, new_known, new_uids)
        place = index.find(keys[last])
        fresh = place < 0
        place[fresh] = index.insert(keys[last[fresh]])
        extra = index.used - len(ids)
        ids, uids, sizes = (np.concatenate([x, np.zeros(extra, np.int64)]) for x in (ids, uids, sizes))
        known = np.concatenate([known, np.zeros(extra, bool)])
        uids[place[fresh]] = -1
        sizes[place] += counts[codes[last]].astype(np.int64)
        now = (new_known[last], new_ids[last], new_uids[last])
        before = (known[place], ids[place], uids[place])
        later = (now[0] > before[0]) | (now[0] == before[0]) & (
            (now[1] > before[1]) | (now[1] == before[1]) & (now[2] > before[2])
        )
        known[place[later]], ids[place[later]], uids[place[later]] = (x[later] for x in now)
    live = np.ones(index.used, bool)
    for keys in gone:
        place = index.delete(keys)
        live[place[place >= 0]] = False
    held = np.flatnonzero(live)
    for at in range(0, len(held), 50_000):
        some = held[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([
            pa.array([x.tobytes() for x in index.keys[some]], pa.binary()), pa.array(ids[some], mask=~known[some]),
            pa.array(uids[some]), pa.array(sizes[some]),
        ], ["digest", "keep_id", "keep_uid", "group_size"])


def live_groups(hashed: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """One row per live digest: the document that stays and the number of copies.

    ``withdrawn`` has digests (column ``digest``) to delete from the index, for
    example of texts whose owners asked for removal.
    """
    entries = hashed.mapInArrow(_merge_copies, ENTRY)
    if withdrawn is not None:
        entries = entries.unionByName(withdrawn.select(
            "digest", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("row_uid"),
            F.lit(0).cast("long").alias("n"), F.lit(True).alias("withdrawn"),
        ))
    return entries.repartition("digest").mapInArrow(_run_index, GROUP)


def exact_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", withdrawn: DataFrame | None = None
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are copies of each other. Of equal
    texts the row with the largest id stays, a null id being lower than all; of
    repeated rows with the same id one stays. Withdrawn texts keep no row
    (keep_id null, group_size 0). An empty table gives no rows; further columns
    of the input are ignored.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "digests")
    digests(docs, text, doc_id).write.parquet(folder)
    hashed = spark.read.parquet(folder)
    return hashed.join(live_groups(hashed, withdrawn), "digest", "left").select(
        "doc_id",
        "keep_id",
        F.coalesce("group_size", F.lit(0).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_uid") == F.col("keep_uid"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _keyed_rows(batches: Iterator[pa.RecordBatch], text: int, doc_id: int) -> Iterator[pa.RecordBatch]:
    """Rows that hold a document as one struct, and its key: the digest of its text, and its id."""
    for batch in batches:
        fields = batch.column(0).flatten()
        data, offsets = bytes_of(fields[text].cast(pa.string()))
        view = memoryview(lowered(data))
        keys = [
            hashlib.sha256(view[a:b]).digest() + (b"" if i is None else i.to_bytes(8, "big", signed=True))
            for a, b, i in zip(offsets[:-1], offsets[1:], fields[doc_id].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["held", "key"])


def drop_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without their exact copies, with all their columns, whatever their names.

    The rows that stay are those of :func:`exact_copies`: null text counts as empty, of copies the largest id stays, a null id
    being the lowest, and of repeated rows one. An empty table stays empty. The id must be a ``long`` column.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "digests")
    digests(docs, text, doc_id).write.parquet(folder)
    groups = live_groups(spark.read.parquet(folder))
    stay = groups.select(
        F.when(F.col("keep_id").isNull(), F.col("digest"))
        .otherwise(F.concat("digest", F.unhex(F.lpad(F.hex("keep_id"), 16, "0"))))
        .alias("key")
    )
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("held"))
    places = docs.columns.index(text), docs.columns.index(doc_id)
    keyed = held.mapInArrow(
        lambda batches: _keyed_rows(batches, *places), T.StructType([*held.schema.fields, T.StructField("key", T.BinaryType())])
    )
    once = keyed.join(stay, "key", "left_semi").dropDuplicates(["key"])
    return once.select(*[F.col("held")[c].alias(c) for c in docs.columns])
