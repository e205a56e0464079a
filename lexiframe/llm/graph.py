"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import cut


def _fold(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (bigint columns).

    Self-loops, repeated edges and null ends are ignored; a node without edges has no row. Every
    round keeps one edge per (node, smaller node), minima are pre-aggregated before the shuffle,
    and only the number of edges and a hash sum reach the driver. Rounds end when the edges no
    longer change: each node then has one edge, to its root.
    """
    e = edges.select(F.greatest(src, dst).cast("bigint").alias("u"), F.least(src, dst).cast("bigint").alias("v"))
    e = cut(e.where("u > v").distinct())
    seen = None
    while (now := _fold(e)) != seen:
        seen = now
        if not now[0]:
            break
        # large star: every larger neighbour of u moves to the smallest one of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour of u, and u itself, move to the smallest one
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(e)
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
