"""Connected components by DataFrame operations alone: distributed union-find with large and small stars.

Large star: each node hands its larger neighbours to its smallest one. Small star: each node hands itself
and its smaller neighbours to the smallest. Minima are partial before each shuffle, and the joins with
them are plain equi-joins whose hot nodes Spark splits. The trees flatten to stars in a logarithmic
number of rounds. Each round is written to the shared folder, so a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.session import drop_table, materialize


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _joined(edges: DataFrame) -> DataFrame:
    return edges.join(_smallest(edges).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).drop("w")


def _round(edges: DataFrame) -> DataFrame:
    """edges: u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _joined(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    pairs = _joined(large)
    small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(pairs.select("u", F.col("m").alias("v")))
    return small.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link: the root is the smallest node it reaches.

    Links may be repeated, in either direction, or loops; null ends take no part. No links: no rows.
    """
    spark = links.sparkSession
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    edges, path = materialize(ends.where(F.col("u") > F.col("v")).distinct(), "links")
    state = None
    while True:
        after, new = materialize(_round(edges), "stars")
        drop_table(spark, path)
        edges, path = after, new
        # equal rows before and after: their number and two sums of their hashes
        low, high = F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(F.xxhash64("u", "v"), 32)
        now = tuple(edges.agg(F.count("*"), F.sum(low), F.sum(high)).first())
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
