"""Connected components of an edge table by alternating large and small stars.

Every round joins each node to its smallest neighbour, so the number of rounds grows
with the logarithm of the graph. Minima are aggregated before the shuffle and
then joined, so that the edges of a hub can be split over tasks. Each round is
written to the shared folder, which cuts the lineage; only two numbers per round reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.session import new_folder


def _joined(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest neighbour of u."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _joined(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node u to the smaller node v."""
    linked = _joined(edges)
    return (
        linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(linked.select("u", F.col("m").alias("v"))).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); the root is the smallest node of the component."""
    spark = edges.sparkSession
    current = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        folder = new_folder(spark, "edges")
        current.write.parquet(folder)
        current = spark.read.parquet(folder)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == before or not now[0]:
            break
        before = now
        current = _small_star(_large_star(current))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
