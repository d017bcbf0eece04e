"""Connected components of a distributed edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each round points every node at its smallest neighbour, jumps pointers
    once, and renames the edges; loops and repeats go, so the edges left shrink
    by a factor each round.  All groupings are minima with partial aggregation,
    and nothing but a row count reaches the driver.
    """
    left = scratch.save(edges.filter("a <> b").distinct(), "edges-0")
    found = None
    turn = 0
    while left.count():
        turn += 1
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to"))
        step = scratch.save(step, f"step-{turn}")
        far = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        jumped = scratch.save(step.join(far, "to").select("node", F.col("far").alias("root")), f"jump-{turn}")
        ends = left.join(jumped.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(jumped.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        left = scratch.save(ends.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"edges-{turn}")
        if found is None:
            found = jumped
        else:
            renamed = jumped.select(F.col("node").alias("root"), F.col("root").alias("to"))
            found = scratch.save(found.join(renamed, "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"found-{turn}")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
