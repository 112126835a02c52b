"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.tables import written


def _pulled(edges: DataFrame, lowest: DataFrame) -> DataFrame:
    """Ties every neighbour of a node to the lowest node that this node knows."""
    return edges.join(lowest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    above = _pulled(both.where("v > u"), lowest)
    return above.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Takes edges whose v is the smaller end."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = _pulled(edges, lowest).where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``id, component``: for each node of an edge, the smallest node that it can reach.

    Alternates the large-star and small-star steps until nothing changes, which takes a number of rounds
    logarithmic in the size of the largest component. A node with very many edges is joined with one row,
    so the adaptive skew join may split it. Edges with a null end and loops count for nothing; a node
    without other edges is not in the result. No edges: no rows.
    """
    current = written(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .distinct(),
        "component-edges",
    )
    state = None
    while True:
        found = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("total"),
        ).first()
        if state == tuple(found) or not found["n"]:
            break
        state = tuple(found)
        current = written(_small_star(_large_star(current)), "component-edges")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
