"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliogrid.session import stage_table


def _stars(both: DataFrame) -> DataFrame:
    """Large star: every node hands its smallest neighbour (or itself) to its larger neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_stars(down: DataFrame) -> DataFrame:
    """Small star: every node links its smaller neighbours, and itself, to the smallest of them."""
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    across = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (u, v: bigint): the label is the smallest node it is joined to.

    Edges only ever point to smaller nodes, and both steps keep components as they are; when nothing changes any more
    every node points at its component's smallest. The number of rounds grows with the logarithm of the nodes. Every
    round is a stored table, so that lineage stays short and a lost executor costs one round.
    """
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges, before = stage_table(down, "links"), None
    while True:
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stage_table(_small_stars(_stars(both)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
