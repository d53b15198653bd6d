"""Connected components of an edge list, by repeated star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.llm.common import store


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one link down, and no centre has one of its own."""
    ends = edges.select(F.col("a").alias("v"), F.col("b").alias("down")).unionAll(
        edges.select(F.col("b").alias("v"), F.lit(None).cast("long").alias("down"))
    )
    down, centre = F.count("down"), F.count_if(F.col("down").isNull())
    seen = ends.groupBy("v").agg(
        (F.min("down") < F.max("down")).alias("two"), ((down > 0) & (centre > 0)).alias("inner")
    )
    return seen.where("two or inner").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the smallest id it can reach.

    Each round is two aggregates and two joins over the edges: every vertex and its larger
    neighbours move to its smallest neighbour, then every vertex and its smaller neighbours.
    The rounds end when only stars are left, after a number that grows with the logarithm of
    the longest path. No vertex's neighbours are ever collected.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = store(down.where("a <> b").distinct(), small=True)
    if current.isEmpty():
        return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    while not _are_stars(current):
        # Large star: links to neighbours above a vertex go to the least of it and its neighbours.
        least = current.unionAll(_turned(current)).groupBy("a").agg(
            F.least(F.min("b"), F.first("a")).alias("least")
        )
        above = _turned(current).withColumnRenamed("b", "above").join(least, "a")
        large = store(above.select(F.col("above").alias("a"), F.col("least").alias("b")), small=True)
        # Small star: a vertex and its neighbours below it go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a").select(
            "a", F.explode(F.array("a", "b")).alias("v"), F.col("least").alias("to")
        )
        current = store(
            moved.where("v <> to").select(F.col("v").alias("a"), F.col("to").alias("b")).distinct(),
            small=True,
        )
    centres = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(centres)
