"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelworks.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie the smaller neighbours of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
    ).first()
    return row["n"], row["x"]


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v); the label is the component's
    smallest node.  Each round is written to the shared folder; rounds grow with the
    logarithm of the component size."""
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = stage(edges.where("u <> v").select(larger, smaller).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
