"""Connected components by repeated contraction, in Spark joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.staging import stage


def components(links: DataFrame) -> DataFrame:
    """`(node, component)` for every node of undirected `(a, b)` links; the component is its smallest node.

    Each round puts the nodes in a new order by hash, points every node to the
    first of itself and its neighbours and contracts the links to what they point to.
    An order that has nothing to do with the numbering leaves at most three
    quarters of the nodes to be expected, whatever the links look like, so a path of
    ascending numbers takes as few rounds as any other; the last node in the order
    always goes, so the rounds end. A node with very many links only meets them in a
    minimum, which partial aggregation takes before the shuffle. Links and
    pointers of a round are written to the shared folder; at the end pointers are
    followed through all rounds. Self-links and repeated links change nothing.
    """
    edges = stage(_both_ways(links), "component-edges")
    first, steps = edges.select(F.col("a").alias("node")).distinct(), []
    while not edges.isEmpty():
        seed = F.lit(len(steps))
        ahead = F.min(F.struct(F.xxhash64("b", seed).alias("place"), "b"))
        own = F.struct(F.xxhash64("a", seed).alias("place"), F.col("a").alias("b"))
        roots = stage(edges.groupBy("a").agg(F.least(ahead, own)["b"].alias("root")), "component-roots")
        steps.append(roots)
        moved = (
            edges.filter("a < b")
            .join(roots, "a")
            .select(F.col("root").alias("a"), "b")
            .join(roots.select(F.col("a").alias("b"), F.col("root").alias("target")), "b")
            .select("a", F.col("target").alias("b"))
        )
        edges = stage(_both_ways(moved), "component-edges")
    if not steps:
        return first.withColumn("component", F.col("node"))
    reached = stage(reduce(_follow, steps, first.withColumn("component", F.col("node"))), "component-reached")
    smallest = reached.groupBy("component").agg(F.min("node").alias("smallest"))
    return reached.join(smallest, "component").select("node", F.col("smallest").alias("component"))


def _follow(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    moved = nodes.join(roots.withColumnRenamed("a", "component"), "component", "left")
    return moved.select("node", F.coalesce("root", "component").alias("component"))


def _both_ways(links: DataFrame) -> DataFrame:
    once = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return once.select(F.explode(ways).alias("way")).select("way.*")


def joined(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """`groups`, a `(node, component)` table or None, with components that new links connect made one."""
    if groups is None:
        return stage(components(links), "component-groups")
    ends = F.array(F.struct(F.col("a").alias("node")), F.struct(F.col("b").alias("node")))
    known = groups.unionByName(
        links.select(F.explode(ends).alias("end")).select("end.node").distinct()
        .join(groups, "node", "left_anti").withColumn("component", F.col("node"))
    )
    known = stage(known, "component-known")
    between = (
        links.join(known.toDF("a", "left"), "a").join(known.toDF("b", "right"), "b")
        .select(F.col("left").alias("a"), F.col("right").alias("b"))
    )
    higher = components(between).toDF("component", "root")
    merged = known.join(higher, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return stage(merged, "component-groups")
