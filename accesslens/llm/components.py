"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Hubs cost no more than others: minima combine map-side and the joins back are
    plain equi joins, whose hot keys the adaptive planner splits.  Rounds end
    when an edge set repeats; each is a written table.  No edges give no rows.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = stage(e, "edges")
    mark = _mark(e)
    while mark[0]:
        e = stage(_small_star(_large_star(e).distinct()).distinct(), "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
