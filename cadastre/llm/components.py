"""Connected components of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared


def components(links: DataFrame) -> DataFrame:
    """Smallest node each node can reach: ``node, component`` for every node in ``a, b``.

    Each round points neighbours at the smallest node of their neighbourhood, first the larger
    ones, then the smaller ones; paths shrink to stars in a logarithmic number of rounds.  Every
    round is a stored table; only a count and a checksum come to the driver.
    """
    edges = shared.stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = shared.stored(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .union(edges.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest of the neighbourhood."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # a node without smaller neighbours is the smallest of its own neighbourhood
    return (edges.select(F.col("a").alias("to"), F.col("b").alias("a"))
            .join(least, "a", "left")
            .select(F.col("to").alias("a"), F.coalesce("m", "a").alias("b"))
            .union(least.select("a", "m")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Point every smaller neighbour of a node, and the node, at the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", "m")).distinct())
