"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.store import Workspace


def connected_components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b bigint); a component is its least node.

    Each step takes minima per node, combined before the shuffle, and joins them back to the
    links; a node with very many links is only a skewed join key with one row on the other side.
    The links are written after each round, and rounds end when a round changes nothing.
    """
    edges = space.write(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-0",
    )
    before, step = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, step = state, step + 1
        edges = space.write(_small_star(_large_star(edges)), f"{name}-{step}")
        space.drop(f"{name}-{step - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    inner = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
