"""Connected components by joins alone: distributed union-find with large and small stars.

Nodes are of any type that can be ordered, also structs. A large star hands the larger neighbours of a node to
its smallest one, a small star hands a node and its smaller neighbours to the smallest. Trees flatten to stars
in a logarithmic number of rounds, long chains included. Each round is written, so a lost executor repeats
one round, and only three numbers a round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.session import drop_table, materialize


def _hand_over(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest node that u reaches, itself included."""
    smallest = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("s"))
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hand_over(both).filter("v > u").select(F.col("v").alias("u"), F.col("s").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    handed = _hand_over(edges)
    own = handed.select("u", F.col("s").alias("v"))
    return own.unionByName(handed.select(F.col("v").alias("u"), F.col("s").alias("v"))).filter("u > v").distinct()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node on an edge; the root is the smallest node it is connected to. Runs jobs.

    Edges may be repeated, point either way or be loops; edges with a null end take no part.
    """
    spark = edges.sparkSession
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    loops = ends.select("x").unionByName(ends.select(F.col("y").alias("x"))).distinct()
    nodes, _ = materialize(loops.withColumnRenamed("x", "node"), "nodes")
    stars, path = materialize(ends.filter("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "stars")
    before = None
    while True:
        after, new = materialize(_small_star(_large_star(stars)), "stars")
        drop_table(spark, path)
        stars, path = after, new
        row_hash = F.xxhash64("u", "v")
        now = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(row_hash), F.sum(F.pmod(row_hash, F.lit(1_000_003)))).first())
        if now == before:
            break
        before = now
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
