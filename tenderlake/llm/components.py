"""Connected components of an undirected graph, DataFrame operations only.

Alternating large-star / small-star rounds: each round links every node to the
smallest node it knows, with one map-side combined ``min`` per node and one
equi-join per star.  No adjacency list is ever built, so a hub that carries a
third of all edges costs a skewed join (which adaptive execution splits), not
a huge group.  The edge set shrinks to one edge per node; rounds grow with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import cut


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _down(pairs: DataFrame) -> DataFrame:
    """Orient pairs from the larger to the smaller node, drop loops and repeats."""
    return (pairs.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``; component = smallest node.

    Edges with a NULL end are ignored; loops alone make no row; an empty edge
    table gives an empty result.  Repeated edges and either direction are fine.
    """
    e = cut(_down(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
                  .select(F.col(src).alias("u"), F.col(dst).alias("v"))))
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour points at the node's smallest
        large = _down(both.join(low, "u").where(F.col("v") > F.col("u"))
                      .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: the node and its smaller neighbours point at the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        e = cut(_down(small))
        old, mark = mark, _mark(e)
        if mark == old:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
