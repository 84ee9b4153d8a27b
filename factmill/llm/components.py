"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = cut(edges)
    return edges, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges (u, v), root being the smallest node that can be reached.

    Each step is one aggregation and one join on the edges that are left; the number of rounds
    grows with the logarithm of the longest path. Self loops and repeated edges do no harm.
    """
    edges, state = _checked(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        before = edges
        edges, after = _checked(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        release(before, large)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
