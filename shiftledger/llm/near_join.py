"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

1. Each text gives the set of its five-word n-grams (64-bit hashes; words are lower-cased
   in A-Z and parted by white space), a digest of its word sequence, and MinHash bands.
   The number of bands and rows follows from the recall wanted at the threshold.
2. Texts with equal word sequences form one node with a count, so copies cost one row.
3. Nodes are shuffled on their band hashes. A node of a bucket is linked to the
   bucket's smallest node only, and connected components of these links bring together
   all nodes that share a bucket, directly or not.
4. Within a component all n-gram sets are compared, block against block, as products
   of 0/1 matrices over the n-grams that two blocks share. A large component is cut
   into blocks of bounded size, and every pair of blocks is a group of its own. A group returns
   one row per node, its number of links and the smallest node it is linked to, never pairs.
5. Links summed over groups, and the components of the verified links, are the result.

The n-gram sets of the nodes that share a bucket come from a second reading of the texts, pruned by a Bloom filter of
their ids. The filter has a fixed size, so it can always be sent to all tasks; ids that it lets through wrongly
are dropped by the join with the nodes, so a full filter costs time and no result. Texts are never shuffled. No
candidate is capped: the links among the nodes of a component are counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.llm.blocks import Hasher, blocks, ink, lowered, mix, spans
from shiftledger.llm.components import components
from shiftledger.session import new_folder

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
MOST_HASHES = 256
BLOCK_GRAMS = 1_000_000  # n-grams in a block of a large component
BLOCK_NODES = 4096
STRIP = 512  # nodes of a block compared at once
FILTER_BITS = 1 << 27  # 16 MB at any number of ids; below 1 % of wrong hits up to 7 million ids
FILTER_HASHES = 2
_SALTS = tuple(pow(0x9E3779B97F4A7C15, 2 * i + 3, 1 << 64) | 1 for i in range(64))


def bands_and_rows(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows per band, and the fewest bands, that find a pair at ``similarity`` with chance ``recall``.

    A band of r rows agrees with chance s**r, so b bands miss a pair with chance
    (1 - s**r)**b. More rows mean fewer false candidates but more hashes in all.
    """
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("this recall takes more hashes than allowed")
    return best


class Grams:
    """N-grams of a block of texts: hashes, number of the text's n-gram, and where each text's begin."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.hasher = words, Hasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = lowered(data)
        starts, ends, first = spans(ink(data), offsets)
        words = np.diff(first)
        count = np.where(words >= self.words, words - self.words + 1, np.minimum(words, 1))
        begin = np.concatenate([[0], np.cumsum(count)])
        order = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
        place = np.repeat(first[:-1], count) + order
        end = np.repeat(first[1:], count)
        hashes = np.append(self.hasher(low, starts, ends), np.uint64(0))
        grams = np.zeros(len(place), np.uint64)
        for i in range(self.words):
            grams += hashes[np.where(place + i < end, place + i, len(hashes) - 1)] * np.uint64(_SALTS[i])
        return mix(grams), order.astype(np.uint64), begin


def digests(grams: np.ndarray, order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """128 bits of each text's n-gram sequence, as two columns; zeros for texts without words."""
    found = np.zeros((len(begin) - 1, 2), np.uint64)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        for i in range(2):
            told = mix(grams * np.uint64(_SALTS[20 + i]) + order * np.uint64(_SALTS[30 + i]))
            found[some, i] = np.add.reduceat(told, begin[:-1][some])
    return found.view(np.int64)


def band_hashes(grams: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each text with words, one row each."""
    rng = np.random.default_rng(1)
    factors, shifts = rng.integers(0, 1 << 32, (2, bands * rows), dtype=np.uint32)
    at = begin[:-1][np.diff(begin) > 0]
    short = (grams >> np.uint64(32)).astype(np.uint32)
    held = np.zeros((len(at), bands), np.uint64)
    for band in range(bands):
        told = np.full(len(at), band + 1, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat(short * (factors[i] | np.uint32(1)) + shifts[i], at)
            told = mix(told * np.uint64(_SALTS[40]) + least.astype(np.uint64))
        held[:, band] = told
    return held.view(np.int64)


def _signature_rows(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    read = Grams(words)
    for batch in batches:
        ids = batch.column("doc_id")
        for low, high, data, offsets in blocks(batch.column("text")):
            grams, order, begin = read(data, offsets)
            told = digests(grams, order, begin)
            some = np.diff(begin) > 0
            held = band_hashes(grams, begin, bands, rows) if some.any() else np.zeros((0, bands), np.int64)
            yield pa.RecordBatch.from_arrays([
                ids.slice(low, high - low), pa.array(told[:, 0]), pa.array(told[:, 1]),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(some * bands)]), pa.int32()), pa.array(held.ravel())
                ),
            ], ["doc_id", "h1", "h2", "bands"])


def _filter_places(ids: DataFrame, bits: int) -> np.ndarray:
    """The Bloom filter of a column ``id``, as ``bits`` / 8 bytes.

    Tasks aggregate the bits of their ids into pieces of 4 KB, of which at most ``bits`` / 32,768 reach the driver.
    """
    place = F.explode(F.array(*[
        F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(bits)).cast("long") + 1 for i in range(FILTER_HASHES)  # bitmaps begin at 1
    ]))
    pieces = (
        ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    held = np.zeros(bits // 8, np.uint8)
    for row in pieces.toLocalIterator():
        own = np.frombuffer(row["bits"], np.uint8)
        at = (row["piece"] - 1) * len(own)
        held[at : at + len(own)] = own[: len(held) - at]
    return held


def _gram_rows(batches: Iterator[pa.RecordBatch], words: int, held: Broadcast) -> Iterator[pa.RecordBatch]:
    """Digests and n-gram sets of the texts whose places are all set in the filter."""
    read, bits = Grams(words), held.value
    for batch in batches:
        hit = np.ones(len(batch), bool)
        for i in range(FILTER_HASHES):
            place = batch.column(f"place{i}").to_numpy()
            hit &= (bits[place >> 3] >> (place & 7)) & 1 == 1
        if not hit.any():
            continue
        for _, _, data, offsets in blocks(batch.column("text").filter(pa.array(hit))):
            grams, order, begin = read(data, offsets)
            told = digests(grams, order, begin)
            sets = [np.unique(grams[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(told[:, 0]), pa.array(told[:, 1]), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], ["h1", "h2", "size", "grams"])


def _shared(left: list[np.ndarray], right: list[np.ndarray], same: bool) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    if same:
        grams, times = np.unique(np.concatenate(left), return_counts=True)
        common = grams[times > 1]
    else:
        common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    total = np.zeros((len(left), len(right)), np.float32)

    def matrix(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
        held = np.zeros((len(sets), len(columns)), np.float32)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
        hit = columns[at] == flat
        held[owner[hit], at[hit]] = 1
        return held

    for i in range(0, len(common), 8192):
        columns = common[i : i + 8192]
        one = matrix(left, columns)
        total += one @ (one if same else matrix(right, columns)).T
    return total


def count_links(
    sets: list[np.ndarray], copies: np.ndarray, block: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set, counted with copies, and the first set of its group of linked sets.

    ``block`` holds 0 or 1. With both present only pairs across the two are compared.
    """
    order = [np.flatnonzero(block == b) for b in (0, 1)]
    across = len(order[0]) and len(order[1])
    strips = [[x[i : i + STRIP] for i in range(0, len(x), STRIP)] for x in order]
    if across:
        pairs = [(a, b, False) for a in strips[0] for b in strips[1]]
    else:
        held = strips[0] or strips[1]
        pairs = [(a, b, i == j) for i, a in enumerate(held) for j, b in enumerate(held) if j >= i]
    links = np.zeros(len(sets), np.int64)
    root = np.arange(len(sets))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    for a, b, same in pairs:
        shared = _shared([sets[i] for i in a], [sets[i] for i in b], same)
        near = shared >= similarity * (sizes[a][:, None] + sizes[b][None, :] - shared) - 1e-3
        if same:
            np.fill_diagonal(near, False)
        links[a] += near @ copies[b]
        if not same:
            links[b] += near.T @ copies[a]
        todo = near.any(axis=1)
        for i in np.flatnonzero(todo):
            linked = b[near[i]]
            tops = {find(int(x)) for x in np.unique(root[linked])} | {find(int(a[i]))}
            top = min(tops)
            for x in tops:
                root[x] = top
    return links, np.array([find(i) for i in range(len(sets))], np.int64)


def _compare_group(group: pa.Table, similarity: float) -> pa.Table:
    nodes = group["node"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["grams"].to_pylist()]
    links, root = count_links(sets, group["copies"].to_numpy(), group["side"].to_numpy(), similarity)
    return pa.table({"node": nodes, "links": links, "root": nodes[root]})


def signatures(docs: DataFrame, text: str, doc_id: str, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, h1, h2, bands) for each row, written to the shared folder."""
    folder = new_folder(docs.sparkSession, "signatures")
    docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(
        lambda b: _signature_rows(b, words, bands, rows), "doc_id long, h1 long, h2 long, bands array<long>"
    ).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _classes(docs: DataFrame, signed: DataFrame, text: str, doc_id: str, words: int, similarity: float) -> DataFrame:
    """One row per node: h1, h2, first_id (smallest id), copies, links, keeper (the node that stands for the class)."""
    spark = docs.sparkSession

    def kept(frame: DataFrame, label: str) -> DataFrame:
        folder = new_folder(spark, label)
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    nodes = kept(
        signed.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")
        ),
        "nodes",
    )
    members = nodes.select(F.col("h1").alias("node"), F.explode("bands").alias("bucket"))
    hubs = (
        members.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    candidates = components(
        members.join(hubs, "bucket").filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    )
    active = kept(
        candidates.join(nodes.drop("bands").withColumn("node", F.col("h1")), "node")
        .select("node", "root", "h1", "h2", "first_id", "copies"),
        "active",
    )
    null_id = F.lit(-(2**63)).cast("long")
    held = spark.sparkContext.broadcast(_filter_places(active.select(F.coalesce("first_id", null_id).alias("id")), FILTER_BITS))
    own = F.coalesce(docs[doc_id].cast("long"), null_id)
    texts = docs.select(docs[text].cast("string").alias("text"), *[
        F.pmod(F.xxhash64(F.lit(i), own), F.lit(FILTER_BITS)).cast("long").alias(f"place{i}") for i in range(FILTER_HASHES)
    ])
    sets = kept(
        texts.mapInArrow(lambda b: _gram_rows(b, words, held), "h1 long, h2 long, size long, grams binary")
        .join(active.select("node", "root", "h1", "h2", "copies"), ["h1", "h2"])
        .dropDuplicates(["h1", "h2"]).select("node", "root", "copies", "size", "grams"),
        "sets",
    )
    blocks_of = sets.groupBy("root").agg(
        F.greatest(F.ceil(F.sum("size") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_NODES)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    grouped = (
        sets.join(blocks_of, "root").withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "copies",
            (F.col("block") > F.col("other")).cast("int").alias("side"), "grams",
        )
    )
    compared = kept(
        grouped.repartition("root", "low", "high").groupBy("root", "low", "high")
        .applyInArrow(lambda group: _compare_group(group, similarity), "node long, links long, root long"),
        "links",
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    verified = components(compared.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    rated = (
        nodes.drop("bands").withColumn("node", F.col("h1")).join(links, "node", "left").join(verified, "node", "left")
        .select(
            "h1", "h2", "first_id", "copies", F.coalesce("links", F.lit(0).cast("long")).alias("links"), "root",
            F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "h1", "h2").alias("self"),
        )
    )
    alone = rated.filter("root is null").withColumn("keeper", F.col("self"))
    linked = rated.filter("root is not null")
    keepers = linked.groupBy("root").agg(F.min("self").alias("keeper"))
    return alone.unionByName(linked.join(keepers, "root")).drop("self", "root")


def near_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, words: int = WORDS, similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies.

    Two documents are linked when the Jaccard similarity of their n-gram sets is
    at least ``similarity``; ``n_links`` counts the other rows that a row is linked to, ``n_copies``
    the rows with the same word sequence (itself too), ``class_id`` is the smallest
    id of the rows linked directly or over others. A text of fewer words than an n-gram has one n-gram, all its
    words. Null text counts as empty; texts without words are equal to each other and linked to nothing else.
    Repeated rows are copies. A null id counts only where its class has no other. An empty table gives no rows.
    """
    bands, rows = bands_and_rows(similarity, recall)
    signed = signatures(docs, text, doc_id, words, bands, rows)
    classes = _classes(docs, signed, text, doc_id, words, similarity)
    return signed.select("doc_id", "h1", "h2").join(classes, ["h1", "h2"]).select(
        "doc_id", F.col("keeper.first_id").alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"),
    )


def _marked_rows(batches: Iterator[pa.RecordBatch], text: int, words: int) -> Iterator[pa.RecordBatch]:
    """Rows that hold a document as one struct, and the digests of its text."""
    read = Grams(words)
    for batch in batches:
        column = batch.column(0).flatten()[text].cast(pa.string())
        told = [digests(*read(data, offsets)) for _, _, data, offsets in blocks(column)]
        flat = np.concatenate(told) if told else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["held", "h1", "h2"])


def drop_near_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, words: int = WORDS, similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One document of each class of :func:`near_copies`, the one with the smallest id, with all its columns, whatever their names.

    Null text counts as empty, and texts without words form one class; a null id stays only where its class has no other; of
    repeated rows one stays. An empty table stays empty.
    """
    bands, rows = bands_and_rows(similarity, recall)
    signed = signatures(docs, text, doc_id, words, bands, rows)
    classes = _classes(docs, signed, text, doc_id, words, similarity)
    null_id = F.lit(-(2**63)).cast("long")
    stay = classes.select("keeper.*").distinct().select("h1", "h2", F.coalesce("first_id", null_id).alias("id"))
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("held"))
    place = docs.columns.index(text)
    marked = held.mapInArrow(
        lambda b: _marked_rows(b, place, words),
        T.StructType([*held.schema.fields, T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())]),
    ).withColumn("id", F.coalesce(F.col("held")[doc_id].cast("long"), null_id))
    keys = ["h1", "h2", "id"]
    once = marked.join(stay, keys, "left_semi").dropDuplicates(keys)
    return once.select(*[F.col("held")[c].alias(c) for c in docs.columns])
