"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a min-aggregation and an equi-join on one end of the edges, so a hub of any degree is
pre-aggregated on the map side and its join partition can be split; no neighbour list is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    kept = edges.join(least, "u")
    return kept.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (the smallest node that it reaches) of every node of an edge table (a, b); loops allowed."""
    pair = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    now = scratch.write(pair.distinct())
    mark = None
    while True:
        then = scratch.write(_small(_large(now).filter("u <> v")).distinct().filter("u <> v"))
        scratch.drop(now)
        now = then
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(seen)
