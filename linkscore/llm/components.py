"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch


#: Edges of a task, on average. A table of few edges is not dealt over many tasks, whose fixed cost would
#: exceed their work; one of many has as many tasks as its edges need.
EDGES_PER_TASK = 200_000


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's least node.

    Each step points a node's neighbours to the least of them, so the number of rounds grows with
    the logarithm of the size of a component. A hub's neighbours meet its minimum in a join that
    adaptive execution can split; no group is gathered.
    """
    edges = scratch.put(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _sum(edges)
    while True:
        tasks = -(-seen[0] // EDGES_PER_TASK) or 1
        large = _star(scratch, edges, True, tasks)
        small = _star(scratch, large, False, tasks)
        now = _sum(small)
        scratch.drop(edges)
        scratch.drop(large)
        edges = small
        if now == seen:
            break
        seen = now
    root = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(scratch: Scratch, edges: DataFrame, both: bool, tasks: int) -> DataFrame:
    """Large-star (both directions): links larger neighbours to the least one. Small-star: smaller ones."""
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        ways = ways.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = scratch.put(ways.groupBy("u").agg(F.least("u", F.min("v")).alias("least")).coalesce(tasks))
    linked = ways.join(least.hint("merge"), "u")
    if both:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    else:
        ends = F.explode(F.array("u", "v")).alias("a")
        out = linked.select(ends, F.col("least").alias("b"))
    out = scratch.put(out.filter("a <> b").distinct().coalesce(tasks))
    scratch.drop(least)
    return out


def _sum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())
