"""Connected components of a link table, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.staging import stage


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of links: a, b.

    Large-star and small-star steps alternate until nothing changes: every node
    hands its larger neighbours, then its smaller ones, to the smallest. No
    step gathers a neighbourhood; each is a minimum per node and a join, and
    the number of steps grows with the logarithm of the longest path. Joins are
    merges at any size: a small broadcast still takes a page of the driver's memory,
    and there are many joins.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.withColumnRenamed("m", "b"))
            .distinct()
        )
        edges = stage(small, "star-links")
        # done when every node hangs on a node that hangs on none
        if edges.join(edges.select(F.col("a").alias("b")).hint("merge"), "b", "left_semi").isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
