"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014) on DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with u > v. Hot nodes are aggregated before the shuffle and joined back, never gathered."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    joined = near.join(least, F.col("u") == F.col("k"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected_components(edges: DataFrame, cut: Callable[[DataFrame, str], DataFrame], most_rounds: int = 50) -> DataFrame:
    """(node, component) for the nodes of edges (u, v); component is the least node that is reachable.

    Direction, loops and repeated edges don't matter; null ends are dropped. cut writes a DataFrame and gives it back
    without its lineage. Ends when a round changes nothing."""
    pair = edges.where("u IS NOT NULL AND v IS NOT NULL").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    nodes = pair.select("u").unionByName(pair.select(F.col("v").alias("u"))).distinct().withColumnRenamed("u", "node")
    now, state = cut(pair.where("u > v").distinct(), "edges"), None
    for _ in range(most_rounds):
        now = cut(_star(_star(now, True), False), "edges")
        new = now.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if new == state:
            return nodes.join(now.withColumnRenamed("u", "node").withColumnRenamed("v", "root"), "node", "left").select(
                "node", F.coalesce("root", "node").alias("component")
            )
        state = new
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
