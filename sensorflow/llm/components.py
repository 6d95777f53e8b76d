"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and its neighbours as m."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    # The struct makes a new key, so the side with a hot u gets an exchange that AQE may split.
    least = least.select(F.struct("u").alias("_k"), F.least("u", "m").alias("m"))
    return edges.withColumn("_k", F.struct("u")).join(least, "_k").drop("_k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_least(both).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _with_least(down)
    return (least.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id that an edge (u, v) names; the component is the least id.

    Every step leaves at most as many edges as before and is written to the shared folder,
    so nothing is recomputed when an executor is lost; the rounds grow with the logarithm of
    the longest chain.
    """
    edges = written(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        edges = written(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
