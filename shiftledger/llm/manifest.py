"""A Merkle manifest of a dataset whose parents keep hash states, so that a changed row is folded to the root cheaply.

Every row is a leaf; the leaves of a tree (here: of a language) are ordered by their keys, runs of ``fanout``
neighbours become a parent, and so on up to the tree's root; the trees' roots are the leaves of one more tree. A
parent keeps the state of its hash before each child slot. To fold a replaced leaf, the parent's state
before its slot is resumed with the replacement and the siblings to the right; those to the left are in the state.

How Spark builds it: the leaves are sorted by range, written, and numbered by counts of each range. Blocks of
``fanout ** height`` neighbours are built in one task each, whatever tree they belong to, so a tree of
any size is spread evenly; the blocks' tops are the leaves of the next layer. Only the few layers are
counted by the driver. To fold, each block gets the path from its top to the root, one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftledger.llm.midstates import Fold, Subtree, bytes_to_words, finish
from shiftledger.session import new_folder

FANOUT = 2
HEIGHT = 12

BLOCK = "tree string, block long, size long, total long, fanout int, levels int, nodes binary, states binary, top binary"
STEP = "struct<slot:int,before:binary,left:array<binary>,right:array<binary>>"


def field(value: Column) -> Column:
    """A value as part of a message: ``-`` for null, else its number of bytes in UTF-8, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The SHA-256 of a row's values, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def as_hex(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def tree_key(value: Column) -> Column:
    """A key that is never null and sorts like the value's bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _numbered(leaves: DataFrame, order: list[str], folder: str) -> DataFrame:
    """The leaves with their position in their tree and the tree's number of leaves (``total``).

    The sorted rows are written once; rows of one range and tree are neighbours, so a position is the number of the
    tree's rows in earlier ranges plus the row's place among those of its own.
    """
    leaves.orderBy("tree", *order).withColumn("at", F.monotonically_increasing_id()).write.parquet(folder)
    rows = leaves.sparkSession.read.parquet(folder).withColumn("run", F.shiftright("at", 33))
    runs = rows.groupBy("tree", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "tree", "run", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total")
    )
    return rows.join(runs, ["tree", "run"]).withColumn("position", F.col("at") - F.col("first") + F.col("before")).drop(
        "run", "first", "before", "at"
    )


def _built(table: pa.Table, fanout: int, height: int) -> pa.Table:
    table = table.sort_by("position")
    leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
    total = table["total"][0].as_py()
    levels = height
    if total <= fanout**height:  # the tree ends here
        levels, reach = 0, 1
        while reach < total:
            levels, reach = levels + 1, reach * fanout
    tree = Subtree.over(leaves, fanout, levels)
    nodes, states = tree.written()
    values = [
        table["tree"][0].as_py(), table["position"][0].as_py() // fanout**height, len(leaves), total, fanout, levels, nodes, states,
        tree.nodes[-1][0].tobytes(),
    ]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in BLOCK.split(", ")])


def _tree(values) -> Subtree:
    return Subtree.read(values["nodes"], values["states"], values["size"], values["fanout"], values["levels"])


def _leaf_paths(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """For every leaf of a block: its steps to the block's top, then the block's own path."""
    kind = pa.list_(pa.struct([
        ("slot", pa.int32()), ("before", pa.binary()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary())),
    ]))
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            tree = _tree(row)
            places = np.arange(row["size"])
            paths: list[list] = [[] for _ in places]
            for slots, before, children, sibling in tree.steps(places):
                held = np.ascontiguousarray(before.T).astype(">u4").view(np.uint8)
                by_slot = [{} for _ in range(row["fanout"])]
                for slot in range(row["fanout"]):
                    rows = np.flatnonzero((slot != slots) & (slot < children))
                    by_slot[slot] = dict(zip(rows.tolist(), map(bytes, sibling(slot, rows)), strict=True))
                for i, slot in enumerate(slots.tolist()):
                    paths[i].append({
                        "slot": slot, "before": held[i].tobytes(),
                        "left": [by_slot[s][i] for s in range(slot)],
                        "right": [by_slot[s][i] for s in range(slot + 1, int(children[i]))],
                    })
            yield pa.RecordBatch.from_arrays([
                pa.array([row["tree"]] * len(places), pa.string()), pa.array(places + row["block"] * size, pa.int64()),
                pa.array([p + row["path"] for p in paths], kind),
                pa.array([row["subroot"]] * len(places), pa.binary()), pa.array([row["root"]] * len(places), pa.binary()),
            ], ["tree", "position", "path", "subroot", "root"])


def _folded(replaced: pa.Table, block: pa.Table, carried: list[str]) -> pa.Table:
    """A block's replaced leaves, folded to the block's top and on along its path."""
    row = block.to_pylist()[0] if block.num_rows else None
    count = replaced.num_rows if row else 0
    replaced = replaced.slice(0, count)
    if count:
        fold = Fold(np.frombuffer(b"".join(replaced["digest"].to_pylist()), np.uint8).reshape(-1, 32))
        places = replaced["place"].to_numpy()
        for step in _tree(row).steps(places):
            fold.step(*step, row["fanout"])
        for step in row["path"]:
            near = step["left"] + [b""] + step["right"]
            before = np.repeat(bytes_to_words(np.frombuffer(step["before"], np.uint8)), count, axis=1)

            def sibling(slot, rows, near=near):
                return np.repeat(np.frombuffer(near[slot], np.uint8)[None], len(rows), axis=0)

            fold.step(np.full(count, step["slot"]), before, np.full(count, len(near)), sibling, row["fanout"])
        folded, proof = fold.digests, finish(fold.proof, fold.met)
    else:
        folded = proof = np.zeros((0, 32), np.uint8)

    def same(name):
        return pa.array([row[name]] * count if count else [], pa.binary())

    return pa.table(
        [replaced[c] for c in carried]
        + [same("subroot"), same("root"), pa.array(map(bytes, proof), pa.binary()), pa.array(map(bytes, folded), pa.binary())],
        [*carried, "subroot", "root", "proof", "folded"],
    )


class Manifest:
    """A written manifest: ``leaves`` (tree, position, total, digest and the carried columns) and the blocks of every layer."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int, height: int) -> None:
        self.spark, self.folder, self.fanout, self.size = spark, folder, fanout, fanout**height
        self.height = height

    @property
    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/numbered")

    def blocks(self, kind: str, layer: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{kind}/{layer}")

    def _layers(self, kind: str, leaves: DataFrame) -> int:
        """Writes layer on layer of blocks until every tree has one top; the number of layers."""
        layer, fanout, height = 0, self.fanout, self.height
        while True:
            dealt = leaves.withColumn("block", F.expr(f"position div {self.size}")).repartition(_tasks(self.spark), "tree", "block")
            dealt.groupBy("tree", "block").applyInArrow(lambda t: _built(t, fanout, height), BLOCK).write.parquet(
                f"{self.folder}/{kind}/{layer}"
            )
            open_ = self.blocks(kind, layer).filter(F.col("total") > self.size)
            layer += 1
            if open_.isEmpty():
                return layer
            leaves = open_.select(
                "tree", F.col("block").alias("position"), F.expr(f"(total + {self.size - 1}) div {self.size}").alias("total"),
                F.col("top").alias("digest"),
            )

    def _build(self, leaves: DataFrame, order: list[str]) -> None:
        _numbered(leaves, order, f"{self.folder}/sorted").write.parquet(f"{self.folder}/numbered")
        self.layers = self._layers("trees", self.leaves.select("tree", "position", "total", "digest"))
        tops = [self.blocks("trees", x).filter(F.col("total") <= self.size) for x in range(self.layers)]
        ends = tops[0]
        for more in tops[1:]:
            ends = ends.unionByName(more)
        ends = ends.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
        _numbered(ends, ["name"], f"{self.folder}/roots").write.parquet(f"{self.folder}/forest_leaves")
        self.forest_layers = self._layers("forest", self._roots().select("tree", "position", "total", "digest"))

    def _roots(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/forest_leaves")

    def _with_paths(self, kind: str, layers: int, end: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The lowest blocks with path, subroot and root; ``end`` adds these to the blocks whose tops are trees' roots."""
        lower, size = None, self.size
        for layer in reversed(range(layers)):
            held = self.blocks(kind, layer)
            full = end(held.filter(F.col("total") <= size))
            if lower is not None:
                more = held.filter(F.col("total") > size).join(lower.withColumnRenamed("position", "block"), ["tree", "block"])
                full = full.unionByName(more)
            if layer:
                lower = self._paths_of(full)
        return full

    def _paths_of(self, blocks: DataFrame) -> DataFrame:
        size = self.size
        return blocks.mapInArrow(
            lambda batches: _leaf_paths(batches, size),
            f"tree string, position long, path array<{STEP}>, subroot binary, root binary",
        )

    def fold(self, replaced: DataFrame) -> DataFrame:
        """The root that each replaced leaf leads to.

        ``replaced`` has tree and position of a leaf, the digest that takes its place, and any columns to carry
        (their names are the caller's; ``place``, ``block`` and the results' names are taken). The results are binary: subroot and
        root of the manifest, proof (the SHA-256 of all siblings on the way), and folded.
        """
        size = self.size
        top = {"path": F.array().cast(f"array<{STEP}>"), "subroot": F.lit(None).cast("binary"), "root": F.col("top")}
        forest = self._paths_of(self._with_paths("forest", self.forest_layers, lambda held: held.withColumns(top)))
        roots = self._roots().select(F.col("name").alias("tree"), "position", F.col("digest").alias("own"))
        above = roots.join(forest.drop("tree"), "position").select("tree", "path", F.col("own").alias("subroot"), "root")
        blocks = self._with_paths("trees", self.layers, lambda held: held.join(above, "tree")).select(
            "tree", "block", "size", "fanout", "levels", "nodes", "states", "path", "subroot", "root"
        )
        carried = [c for c in replaced.columns if c not in ("tree", "position", "digest")]
        dealt = replaced.withColumn("block", F.expr(f"position div {size}")).withColumn("place", F.expr(f"position % {size}"))
        tasks = _tasks(self.spark)
        kinds = [f"`{c}` {replaced.schema[c].dataType.simpleString()}" for c in carried]
        return (
            dealt.repartition(tasks, "tree", "block").groupBy("tree", "block")
            .cogroup(blocks.repartition(tasks, "tree", "block").groupBy("tree", "block"))
            .applyInArrow(
                lambda left, right: _folded(left, right, carried),
                ", ".join([*kinds, "subroot binary", "root binary", "proof binary", "folded binary"]),
            )
        )


def write_manifest(
    leaves: DataFrame, order: list[str], *, fanout: int = FANOUT, height: int = HEIGHT, folder: str | None = None
) -> Manifest:
    """Builds the manifest of ``leaves``: columns tree (not null, see ``tree_key``), digest (32 bytes) and others to carry.

    Leaves of a tree ascend by the columns of ``order`` (null first), then by digest, so equal keys have a defined order; trees
    by their key's bytes. A tree of one leaf has that leaf as its root. Without any leaf there are no blocks, and folds
    return no rows. Reserved names: position, total, block, at, run. A fanout of 2 or more and blocks of ``fanout ** height`` leaves are
    parameters; the root depends on the fanout only.
    """
    if fanout < 2 or height < 1:
        raise ValueError("a manifest needs a fanout of at least 2 and a height of at least 1")
    spark = leaves.sparkSession
    made = Manifest(spark, folder or new_folder(spark, "manifest"), fanout, height)
    made._build(leaves, [*order, "digest"])
    return made


def verified_documents(docs: DataFrame, changed: Column, **parameters) -> DataFrame:
    """A manifest of documents, and what becomes of the root when ``changed`` rows count one character more.

    One row per document: doc_id, leaf, subroot, root, proof_sha256 (of the documents as they are), folded_root (of the
    changed leaf, if changed) and verified (it equals root); digests in lowercase hex. The leaf hashes doc_id, source, lang, n_chars
    and text, nulls as such, whole texts. Trees are languages (null is one of its own), leaves ascend by doc_id. A
    null n_chars stays null. Repeated rows are leaves of their own; other columns are not read.
    """
    values = [docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [v + 1 if i == 3 else v for i, v in enumerate(values)]
    leaves = docs.select(
        tree_key(docs["lang"]).alias("tree"), leaf(*values).alias("digest"), docs["doc_id"].cast("long").alias("doc_id"),
        F.when(F.coalesce(changed, F.lit(False)), leaf(*more)).alias("changed"),
    )
    manifest = write_manifest(leaves, ["doc_id"], **parameters)
    replaced = manifest.leaves.select(
        "tree", "position", F.coalesce("changed", "digest").alias("digest"), "doc_id", F.col("digest").alias("leaf")
    )
    return manifest.fold(replaced).select(
        "doc_id", as_hex("leaf").alias("leaf"), as_hex("subroot").alias("subroot"), as_hex("root").alias("root"),
        as_hex("proof").alias("proof_sha256"), as_hex("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
