"""Connected components of a large graph with alternating star steps.

Every step is an aggregation (map-side combined) and a join on the node, so a hub with very many
neighbours is never collected; adaptive execution splits its join partition. Steps write their
edges to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hop = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hop.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return (r["n"], r["h"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)`` for every node of ``edges (u, v)`` (longs): ``label`` is the smallest node
    reachable. Self-links are ignored; an empty graph gives no rows. Rounds grow with the logarithm
    of the longest chain."""
    scratch = Scratch(edges.sparkSession)
    e = scratch.written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                        f"{name}-edges")
    before = _state(e)
    while before[0]:
        last, e = e, scratch.written(_small_star(_large_star(e)), f"{name}-star")
        scratch.free(last)
        now = _state(e)
        if now == before:
            break
        before = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
