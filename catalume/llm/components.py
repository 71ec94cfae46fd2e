"""Connected components of a graph that may be of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalume.llm.common import remove, stored


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for every node of links (a, b: long). Loops, repeats and nulls do no harm; no links, no rows.

    Each round hangs nodes under the smallest neighbour; the number of rounds grows as the logarithm of the longest path. Every round is written to the
    shared folder, so lineage stays short, and hot nodes are reduced by partial aggregation before joins that AQE may split.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct()
    edges, mark = _written(edges)
    nodes = edges
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        following, now = _written(small)
        if edges is not nodes:
            remove(edges.sparkSession, edges)
        edges = following
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = stored(edges, "edges")
    return edges, tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
