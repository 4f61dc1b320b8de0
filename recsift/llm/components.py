"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the shared folder's tables; no
component, link list or label is gathered in one task or on the driver. A hot
centre's rows meet one row of its minimum, a join that adaptive execution
splits. The number of steps grows with the logarithm of the longest chain; edges
that are stars already take none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.rows import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")) \
        .unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    return (both.join(least, "x").filter("y > x and y <> m")
            .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one edge and is no other edge's ``v``: no step changes that."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))) \
        .groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id in a link to another id; ``component``
    is the smallest id reachable. Null ends and self links are ignored."""
    stars = saved(edges.filter(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while not _are_stars(stars):
        stars = saved(_small_star(_large_star(stars)))
    return (stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")))
            .distinct())
