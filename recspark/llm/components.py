"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _state(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of an edge; the label is the smallest node of its component.

    Each round is a few joins and aggregates over the edges (map-side minima,
    so a node with very many edges is no single task); the number of rounds
    grows with the logarithm of the longest chain.  Rounds are written to the
    shared folder.  Null ends and loops are ignored.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    now = saved(edges.where(F.col(a) != F.col(b)).select(hi.alias("hi"), lo.alias("lo")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi != lo").distinct())
        large = saved(large, "large-star")
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(below, "hi")
        after = saved(small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi != lo")
                      .unionByName(below.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        new_state = _state(after)
        now, done = after, new_state == state
        state = new_state
        if done:
            break
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(roots)
