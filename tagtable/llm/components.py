"""Connected components of a graph given as a table of edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagtable.llm.store import saved, tidy


def components(edges: DataFrame) -> DataFrame:
    """``id, comp`` of every vertex in ``a, b``: the smallest vertex of its component.

    Rounds of the large-star and small-star operations: every vertex hands its larger neighbours, then its
    smaller ones, to the smallest vertex that it knows, until only stars are left, which no round would change. The
    number of rounds grows with the logarithm of the graph's size; a graph of stars, such as an earlier result, takes
    none. Every round is written, and no edge comes to the driver.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not _stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.where("a <> b").distinct())
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("x"), "m", "a")
        handed = small.select(F.col("x").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        now = saved(handed.where("a <> b").distinct())
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return stars.union(now.select("b", "b").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each vertex has one smaller neighbour, which has none itself, or has none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    others = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0")
    with tidy(edges.sparkSession):
        return others.isEmpty()
