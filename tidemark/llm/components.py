"""Connected components of a graph given by an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every vertex that has an edge; the component is its
    smallest id.

    Alternating stars: every vertex links its larger neighbours to its smallest
    one, then its smaller neighbours, until nothing changes.  The edges never
    grow in number and depth halves each round.  Each round is written to the
    shared folder; only a count comes to the driver.
    """
    e = stage(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select("v", "m").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        new = stage(small, "edges")
        # a star: no vertex is both a centre and a leaf, and no leaf has two centres
        leaves = new.groupBy("u").count()
        done = (new.select(F.col("v").alias("u")).distinct().join(leaves, "u", "left_semi").isEmpty()
                and leaves.where("count > 1").isEmpty())
        e = new
        if done:
            break
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
