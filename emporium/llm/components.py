"""Connected components of a graph given as an edge table, by star contraction.

Alternates the two star operations until every vertex points at the least
vertex of its component.  Each operation is a map-side-combined minimum per
vertex and one join back, so a vertex of very high degree is never collected;
the edges of each round are written to the shared checkpoint folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import scratch_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (columns u, v) that is not the
    least of its component; component is the least vertex reachable."""
    own = scratch_table(edges.select("u", "v").where("u <> v").distinct(), name)
    before = _print(own)
    while before[0]:
        own = scratch_table(_small_star(_large_star(own)), name)
        now = _print(own)
        if now == before:
            break
        before = now
    return own.select(F.col("u").alias("id"), F.col("v").alias("component"))
