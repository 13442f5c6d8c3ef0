"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import settle


def _sum(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """Component of every node of an undirected link table (a, b), both long.

    Returns node, component (the smallest node reachable). Nodes without a link to another
    node are absent. A large-star step hangs a node's larger neighbours on its smallest one,
    a small-star step does so with its smaller ones; stars are left at the end, after
    about as many rounds as the logarithm of the longest path. Minima are taken by partial aggregation, so a node with very many
    links stays cheap; every round is written to the shared folder.
    """
    tidy = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = settle(tidy.distinct(), "links")
    before = _sum(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.unionByName(least.select("a", F.col("m").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = settle(small.distinct(), "links")
        after = _sum(now)
        if after == before:
            break
        before = after
    # Every larger node hangs on the smallest of its component; that one is its own.
    return (
        now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    )
