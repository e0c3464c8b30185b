"""Connected components of links between texts, by alternating star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, keep

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node it is linked with, itself included) for every node of links (a, b).

    Each round hangs every node's larger neighbours, then its smaller ones, onto the smallest node in its neighbourhood;
    minima are taken with partial aggregation and joined back, so that no task holds a node's neighbours. Every round's
    edges are written out. Ends when a round changes nothing.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _sum(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = keep(small.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(edges)
        edges, now = after, _sum(after)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _sum(edges: DataFrame) -> tuple:
    """Number of edges, and two sums over their hashes: equal for equal sets."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.hash("u", "v").cast("long"))).first())
