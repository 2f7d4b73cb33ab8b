"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import checkpointed


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Hangs each node's larger (or smaller) neighbours and itself on the least of them all."""
    near = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    hung = near.join(least, "a")
    if small:
        moved = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    else:
        moved = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node.

    Each round is two aggregates with joins back, so a node with many links needs no list of them. Rounds grow with the
    logarithm of a component's width. Edges are cut from their lineage after each round.
    """
    edges = checkpointed(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), few=True)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        edges = checkpointed(_stars(_stars(edges, small=False), small=True), few=True)
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
