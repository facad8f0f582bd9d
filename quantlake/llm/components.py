"""Connected components by alternating large-star and small-star steps, all in joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantlake.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over undirected edges (u > v): each node hands its neighbours (larger, or smaller and itself) its least one."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))).first()
    return tuple(r)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (least node reachable) of every node of the links that isn't the least itself.

    Steps go on until the edges, which only ever point to smaller nodes, stay the same;
    each is written to the shared folder, so a lost executor repeats one step.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_star(_star(edges, True), False), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
