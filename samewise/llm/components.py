"""Connected components of an edge table by contraction; every round is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, stored


def components(edges: DataFrame, home: str) -> DataFrame:
    """(node, root) of every node of edges (a, b), root being the same for all nodes that links connect.

    Each round hooks every node to the smallest of itself and its neighbours and replaces nodes by
    what they hook to, until no edge is left. Node ids are digests, so their order is random and
    chains of hooks stay short: rounds grow with the logarithm of the largest component. Only the
    question whether edges are left comes to the driver.
    """
    spark = edges.sparkSession
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), f"{home}/edges-0")
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    number = 0
    while not edges.isEmpty():
        number += 1
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), f"{home}/hooks-{number}")
        left, right = hooks.toDF("a", "ta"), hooks.toDF("b", "tb")
        following = stored(edges.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b")).filter("a <> b").distinct(), f"{home}/edges-{number}")
        roots = stored(roots.join(hooks.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"{home}/roots-{number}")
        for old in (f"edges-{number - 1}", f"hooks-{number}", f"roots-{number - 1}"):
            remove(spark, f"{home}/{old}")
        edges = following
    return roots
