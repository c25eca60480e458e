"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of edges (u, v longs): the least node reachable. Nodes without an edge are left out.

    Every step replaces edges by edges to smaller nodes and keeps connectivity; it ends when an iteration changes nothing.
    The minimum over neighbours is a pre-aggregated sum-like aggregate, so a node with very many neighbours is no single
    task's group. Each iteration is written to the shared folder.
    """

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        return r["n"], r["x"]

    def pointed(e: DataFrame, least: DataFrame) -> DataFrame:
        return e.join(least, "u")

    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pointed(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = pointed(large, low).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = materialise(small, "stars")
        after = state(now)
        if after == before:
            break
        before = after
    stars = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return stars.union(stars.select("component", "component").toDF("node", "component").distinct())
