"""Connected components by alternating star contractions; no group is ever held together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for all nodes of ``links`` (u, v) but the
    labels themselves. Loops, repeats and either direction are fine; no links give no rows.

    Each round ties every node's larger neighbours to its smallest one, then its smaller neighbours
    likewise, until nothing changes: the edges then are stars. Rounds grow with the logarithm of the
    longest path. Neighbours are reduced to a minimum before they are shuffled, and joined with it,
    so that a node of very many links is split like any skewed join key.
    """
    edges = scratch.table(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "least").alias("least"))
        large = scratch.table(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        )
        least = _least(large)
        edges = scratch.table(
            large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v")
            .union(least.select("u", F.col("least").alias("v"))).distinct()
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
