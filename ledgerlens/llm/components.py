"""Connected components of a stored link table, by alternating large-star and small-star steps.

Every step is a map-side combined minimum and a join on the node, so a node with very many links is split like any
skewed join key. Nothing but two counts of each step reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .marks import few_tasks


TASK_LINKS = 100_000


def _star(pairs: DataFrame, large: bool, size: int) -> DataFrame:
    """One step over at most ``size`` directed pairs (u, v): each kept neighbour of u is linked to the least around u."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    least = materialize(few_tasks(least, size, TASK_LINKS), "star-least")
    joined = pairs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        own = least.where("u <> low").select("u", F.col("low").alias("v"))
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(own)
    return materialize(few_tasks(out.where("u <> v").distinct(), size, TASK_LINKS), "star-links")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one link and no node that is linked to is linked on."""
    counts = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("nodes")).first()
    if counts["n"] != counts["nodes"]:
        return False
    return edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: integers); component is the least node reachable.

    Links may repeat, be given either way or lead from a node to itself; no links give an empty result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    nodes = edges.where("u = v").select("u").distinct()
    size = 2 * links.count()
    edges = materialize(few_tasks(edges.where("u <> v").distinct(), size, TASK_LINKS), "star-links")
    while not _all_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, True, size)
        downward = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = _star(downward, False, size)
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = found.select("component").unionByName(nodes.select(F.col("u").alias("component"))).distinct()
    roots = roots.join(found.select(F.col("node").alias("component")).distinct(), "component", "left_anti")
    return found.unionByName(roots.select(F.col("component").alias("node"), "component"))
