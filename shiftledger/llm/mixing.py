"""Mixing sources to target weights by Pareto order sampling.

Sources get targets in proportion to their weights, none above ``MOST_COPIES`` times its
size; what a full source leaves is shared among the others by weight. The targets are those of
filling water to one level over caps, found from sorted running sums. Inside a source the target is
spread over its documents in the same way, in proportion to size times intensity (short documents have
less), so a document's expected number of copies m lies between 0 and ``MOST_COPIES``.

floor(m) copies are certain. For the rest each document draws a uniform u from a hash of
its id and is ranked by the random odds divided by the inclusion odds, u / (1 - u) over
f / (1 - f) with f = m - floor(m); documents are taken by rank until their words
reach what is left of the target. The sample thus has a fixed size, counted in words.

Nothing is ranked as a whole: ranks are cut into ``BINS`` bins, words are summed per source and
bin, and only the one bin in which a source's target ends is put in order. The
decision is then a comparison with one cut per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.session import new_folder

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SHORT_WORDS = 50
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def intensity(size: Column) -> Column:
    """Relative inclusion odds of a document: short documents have half of the others'."""
    return F.when(size < SHORT_WORDS, 1).otherwise(2).cast("long")


def fill(rows: DataFrame, within: list[str], order: list[Column], cap: str, weight: str, total: str) -> DataFrame:
    """Adds ``level`` and ``full``: a full row gets its cap, another ``level * weight``.

    Rows are ordered by cap per weight; a row is full if its share of what the rows before it
    leave exceeds its cap, and also without any weight.
    """
    ascending = Window.partitionBy(*within).orderBy(F.try_divide(F.col(cap), F.col(weight)), *order)
    before = F.coalesce(F.sum(cap).over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(weight).over(ascending.rowsBetween(0, Window.unboundedFollowing))
    left = F.col(total).cast("double") - before.cast("double")
    tried = rows.withColumn("left", left).withColumn("rest", rest.cast("double"))
    tried = tried.withColumn("full", F.coalesce(F.col("left") * F.col(weight) > F.col(cap) * F.col("rest"), F.lit(True)) | (F.col(weight) == 0))
    everywhere = Window.partitionBy(*within)
    # all rows that are not full share the level of the first of them, which has the largest rest
    first = F.max(
        F.when(~F.col("full"), F.struct("rest", F.try_divide("left", "rest").alias("level")))
    ).over(everywhere)
    return tried.withColumn("level", first["level"]).drop("left", "rest")


def rate(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    """The documents (whole rows in ``mix_held``) with a size, an intensity and a uniform draw."""
    words = F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    own = docs[doc_id].cast("string")
    key = F.coalesce(own, F.concat(F.lit("text "), F.md5(F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary"))))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("mix_held"), docs[source].cast("string").alias("mix_source"), docs[doc_id].cast("long").alias("mix_id"),
        F.monotonically_increasing_id().alias("mix_row"), words.alias("mix_size"), intensity(words).alias("mix_intensity"),
        ((drawn + F.lit(0.5)) / F.lit(float(1 << 52))).alias("mix_u"),
    )


def source_targets(rated: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source and intensity: source, sizes, target of the source, expected copies of its documents."""
    levels = rated.groupBy("mix_source", "mix_intensity").agg(F.sum("mix_size").alias("level_size"))
    sources = levels.groupBy("mix_source").agg(F.sum("level_size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1) % len(weights)
    sources = (
        sources.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
    )
    filled = fill(sources, [], [F.col("mix_source").asc_nulls_last()], "cap", "weight", "all_size")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    targets = filled.select(
        F.col("mix_source").alias("target_source"), "source_size", target.alias("target")
    )
    levels = (
        levels.join(targets, F.col("mix_source").eqNullSafe(F.col("target_source"))).drop("target_source")
        .withColumn("cap", F.col("level_size") * most).withColumn("weight", F.col("level_size") * F.col("mix_intensity"))
    )
    filled = fill(levels, ["mix_source"], [F.col("mix_intensity")], "cap", "weight", "target")
    copies = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.col("level") * F.col("mix_intensity"), F.lit(float(most))))
    return filled.select("mix_source", "mix_intensity", "level_size", "source_size", "target", copies.alias("copies"))


def with_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", *,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES,
) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_copies (0 to ``most``) as further columns.

    Null text has size 0 and null sources are one source, last in order. A null id draws by its text.
    Repeated rows have equal ranks and are told apart by their place in the
    table written first. Documents without words are not taken, and sources without words have the target 0. An empty table gives no rows.
    """
    spark = docs.sparkSession

    def kept(frame: DataFrame, label: str) -> DataFrame:
        folder = new_folder(spark, label)
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    rated = kept(rate(docs, text, doc_id, source), "rated")
    levels = kept(source_targets(rated, weights, most), "targets")
    of_level = levels.select(
        F.col("mix_source").alias("level_source"), F.col("mix_intensity").alias("level_intensity"), "source_size", "target", "copies"
    )
    part = F.col("copies") - F.floor("copies")
    rank = F.col("mix_u") * (1 - part) / ((1 - F.col("mix_u")) * part)
    ranked = rated.join(
        of_level, F.col("mix_source").eqNullSafe(F.col("level_source")) & (F.col("mix_intensity") == F.col("level_intensity"))
    ).drop("level_source", "level_intensity").withColumn("rank", F.when(part > 0, rank))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))

    left = levels.groupBy("mix_source").agg(
        (F.max("target") - F.sum(F.floor("copies") * F.col("level_size"))).alias("left_size")
    ).withColumnRenamed("mix_source", "left_source")
    sums = ranked.filter("rank is not null").groupBy("mix_source", "bin").agg(F.sum("mix_size").alias("bin_size"))
    running = Window.partitionBy("mix_source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        sums.withColumn("before", F.coalesce(F.sum("bin_size").over(running), F.lit(0).cast("long")))
        .join(left, F.col("mix_source").eqNullSafe(F.col("left_source")))
        .filter("before <= left_size and before + bin_size > left_size")
        .select(F.col("mix_source").alias("edge_source"), F.col("bin").alias("edge_bin"), "before", "left_size")
    )
    edge = kept(edge, "edges")
    in_order = Window.partitionBy("mix_source").orderBy("rank", F.col("mix_id").asc_nulls_first(), "mix_row")
    through = F.sum("mix_size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = (
        ranked.select("mix_source", "mix_id", "mix_row", "mix_size", "rank", "bin")
        .join(edge, F.col("mix_source").eqNullSafe(F.col("edge_source")) & (F.col("bin") == F.col("edge_bin")))
        .withColumn("through", through)
        .filter(F.col("before") + F.col("through") - F.col("mix_size") / 2 <= F.col("left_size"))
        .groupBy("mix_source")
        .agg(F.max(F.struct("rank", F.coalesce("mix_id", F.lit(-(2**63)).cast("long")).alias("id"), "mix_row")).alias("last"))
        .withColumnRenamed("mix_source", "last_source")
    )
    cuts = kept(
        edge.join(last, F.col("edge_source").eqNullSafe(F.col("last_source")), "left").select("edge_source", "edge_bin", "last"),
        "cuts",
    )
    self = F.struct("rank", F.coalesce("mix_id", F.lit(-(2**63)).cast("long")).alias("id"), "mix_row")
    taken = F.col("rank").isNotNull() & (
        F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin"))
        | ((F.col("bin") == F.col("edge_bin")) & F.coalesce(self <= F.col("last"), F.lit(False)))
    )
    return ranked.join(cuts, F.col("mix_source").eqNullSafe(F.col("edge_source")), "left").select(
        *[F.col("mix_held")[c].alias(c) for c in docs.columns], "mix_size", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        F.when(F.col("mix_size") > 0, F.floor("copies") + taken.cast("long")).otherwise(F.lit(0)).cast("long").alias("mix_copies"),
    )


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixture itself: each document as often as it is taken."""
    columns = docs.columns
    held = docs.select(
        docs[text].alias("text"), docs[doc_id].alias("doc_id"), docs[source].alias("source"),
        F.struct(*[docs[c] for c in columns]).alias("held"),
    )
    found = with_copies(held, **options).filter("mix_copies > 0")
    found = found.select("held", F.explode(F.sequence(F.lit(1).cast("long"), "mix_copies")))
    return found.select(*[F.col("held")[c].alias(c) for c in columns])
