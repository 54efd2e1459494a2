"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import write_and_read


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """Node and component (the smallest node of it) of every node with an edge.

    `edges` has columns a and b; direction, loops and repeats do not matter. A round
    takes the smallest neighbour of each node by a pre-aggregated groupBy and joins it
    back, so no task gathers a node's neighbours; rounds grow with the logarithm of
    the longest path. Each round's edges are written to the shared folder.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = write_and_read(edges, "edges", small=True)
    before = _state(edges)
    while True:
        # large star: the larger neighbours of a node go to its smallest neighbour
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: the smaller neighbours of a node, and itself, go to the smallest of them
        wide = wide.distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        low = wide.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = write_and_read(low.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges", small=True)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
