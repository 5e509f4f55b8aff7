"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a min-aggregate (combined map-side) and a join back, so a node with very many
neighbours is pre-aggregated.  The minima are written as a table, so that both sides of the join
are exchanged for it and adaptive execution can split such a node.  The edges are checkpointed
between rounds; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import checkpointed, stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = stored(e.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Map each node of ``edges`` to the smallest node of its component.

    Nulls and self loops make no edge; repeated and reversed edges count once.  Nodes without an
    edge to another node have no row.  Returns (node, component), with the type of ``src``.
    """
    a, b = F.col(src), F.col(dst)
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct()
    )
    e = checkpointed(e)
    mark = _mark(e)
    while mark[0]:
        e = checkpointed(_small_star(checkpointed(_large_star(e).where("u <> v").distinct())).where("u <> v").distinct())
        last, mark = mark, _mark(e)
        if last == mark:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
