"""Connected components of an undirected edge list, by alternating star contraction.

Each round first links every node's larger neighbours to its smallest one
(large star), then every node's smaller neighbours (small star). Both are an
aggregate and a join, with map-side minima, so a node with very many
neighbours is never gathered in one task. A round's edges are written and read
back: a checkpoint would hand on the size that Spark estimates for them, which
each join multiplies, to the next round, and its digits then fill the driver. The edges become stars around the
smallest node of each component in a logarithmic number of rounds; rounds go
on until the edge set no longer changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import hot_join, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (hot_join(both.filter("v > u"), least, ["u"])
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = hot_join(edges, least, ["u"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: the smallest node of its component, for every node of an edge between two nodes."""
    now = written(edges.filter(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            roots = now.select("v").distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
        state = after
