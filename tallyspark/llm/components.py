"""Connected components by alternating large and small stars (Kiveris et al., "Connected Components in MapReduce and
Beyond"). Every round is two aggregations and two joins; rounds are written to the shared folder, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import Scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, label`` of every node that has a link, from ``links(u, v)``; the label is the component's smallest node."""
    edges = scratch.keep(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(),
                         f"{name}_links")
    state, n = None, 0
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        state, n = now, n + 1
        edges = scratch.keep(_small(_large(edges)), f"{name}_round_{n}")
