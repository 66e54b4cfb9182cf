"""Connected components by repeated star contraction, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps alternate until nothing changes; each halves the depth of the
    trees, so the rounds grow with the logarithm of the longest path. A hub with any number of edges
    costs one aggregate with map-side combine and one join that adaptive execution splits; no list of
    neighbours is ever built. Each round is a stored table. Self-loops keep lone nodes; rows with a
    NULL end are left out.
    """
    pairs = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    lone = pairs.where("a = b").select(F.col("a").alias("node")).distinct()
    stars = stored(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    )
    before = None
    while True:
        mark = _fingerprint(stars)
        if mark == before:
            break
        before = mark
        stars = stored(_small_star(_large_star(stars)))
    nodes = stars.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = stars.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return nodes.union(roots).union(lone.select("node", F.col("node").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component")
    )


def _fingerprint(stars: DataFrame) -> tuple:
    hashed = F.xxhash64("v", "u")
    return tuple(stars.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(20,0)"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).union(
        stars.select(F.col("u").alias("x"), F.col("v").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them."""
    least = stars.groupBy("v").agg(F.min("u").alias("m"))
    moved = stars.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.union(least.select("v", F.col("m").alias("u"))).distinct()
