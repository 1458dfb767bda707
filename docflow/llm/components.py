"""Connected components of an edge list; in lists of more than FEW edges no hub and no component is in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docflow.llm.frames import FEW, forget, saved


def _least(pairs: DataFrame) -> DataFrame:
    """(u, low): the least neighbour of each u."""
    return pairs.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = _dealt(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), few)
    low = _least(both).select("u", F.least("u", "low").alias("low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _least(down)
    leaves = down.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return _dealt(leaves.union(low.select("u", F.col("low").alias("v"))), few)


def _all_stars(edges: DataFrame, few: bool) -> bool:
    """Whether every vertex is either a root or has one edge, which leads to a root."""
    ends = _dealt(edges.select(F.col("u").alias("id"), "v").union(edges.select("v", F.lit(None).cast("long"))), few)
    seen = ends.groupBy("id").agg(F.count("v").alias("up"), F.count_if(F.col("v").isNull()).alias("down"))
    return seen.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def _dealt(edges: DataFrame, few: bool) -> DataFrame:
    return edges.coalesce(1) if few else edges


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex on an edge (u, v); the component is its least vertex.

    Alternating large and small stars: every vertex links to its least neighbour until
    only stars are left, a number of rounds that grows with the logarithm of the longest
    path. Each round is written once; a hub's edges are reduced before the shuffle and
    joined as a skewed key. The rounds of at most FEW edges, which never become more, are the
    same on one partition. Null ends, loops and repeated edges are ignored. The result is
    a saved table.
    """
    now = saved(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    few = now.count() <= FEW
    while True:
        was, now = now, saved(_small_star(_large_star(now, few).filter("u <> v"), few).filter("u <> v").distinct(), "edges")
        forget(was)
        if _all_stars(now, few):
            break
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    ends = _dealt(now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots), few)
    out = saved(ends.distinct(), "components")
    forget(now)
    return out
