"""Connected components over a table of links, by alternating large-star and small-star steps.

Each step is a grouped minimum with map-side combine and an equi-join that adaptive
execution can split, so a node with very many links is no bottleneck; links only ever
shrink towards stars, and every round is cut with a staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of comparable ids to ``(u, v)``: every linked node that is not the
    least of its component, with that least node. Nodes without links are absent."""
    now = staged(edges.where("u != v").select("u", "v").distinct(), "links")
    before = None
    after = _signature(now)
    while after != before:
        before, old = after, now
        now = staged(_small_star(_large_star(old)), "links")
        discard(old)
        after = _signature(now)
    return now
