"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under the smallest node it knows (edges may repeat)."""
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours under the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(low.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one parent, and no parent has one."""
    nodes = edges.groupBy("u").agg(F.count("*").alias("n"))
    if not nodes.filter("n > 1").isEmpty():
        return False
    return edges.join(nodes.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges (u, v) -> node, root: the smallest node of its component, for every node but the roots.

    The two steps are repeated until every component is a star.  Each step is a written
    table; minima combine inside each task first, and the joins are plain equality joins, so
    a hub is no hot task.  Rounds grow with the log of the longest chain."""
    edges = saved(edges.select("u", "v").filter("u != v").distinct(), name)
    while not edges.isEmpty():
        edges = saved(_small_star(saved(_large_star(edges), name)), name)
        if _is_stars(edges):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
