"""Hybrid lists: fuse a rating list with a review list, rebuild a top-k per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators.recs import explode_recs


def review_split(splits: DataFrame, which: str) -> DataFrame:
    """``(user_id, item_id, is_reviewed)`` of one split. The review flag travels
    with the split rows, so no second join with the full table is needed."""
    return (splits.filter(F.col("split") == which)
            .select("user_id", "item_id", "is_reviewed"))


def fuse_scores(rating_long: DataFrame, review_long: DataFrame,
                weight: float | None = None) -> DataFrame:
    """Full outer combination of two long lists on (user, item).

    Missing scores count as 0 and ``rating = rev_rating * weight + rat_rating``
    (``weight=None`` leaves the two scores unweighed, for :func:`weigh`).
    Written as a union and a group-by on the pair (each side has at most one
    row per pair), which is a full outer join with zero fill planned as one
    hash aggregate instead of a sort-merge join.
    """
    rat = rating_long.select("user_id", "item_id", F.col("rating").cast("double").alias("rat"),
                             F.lit(None).cast("double").alias("rev"))
    rev = review_long.select("user_id", "item_id", F.lit(None).cast("double").alias("rat"),
                             F.col("rating").cast("double").alias("rev"))
    both = rat.unionByName(rev).groupBy("user_id", "item_id").agg(
        F.coalesce(F.max("rat"), F.lit(0.0)).alias("rat_rating"),
        F.coalesce(F.max("rev"), F.lit(0.0)).alias("rev_rating"))
    if weight is None:
        return both
    return both.withColumn("rating", F.col("rev_rating") * F.lit(float(weight)) + F.col("rat_rating"))


def weigh(fused: DataFrame, weights: list[float]) -> DataFrame:
    """Score every fused pair under each weight: ``(weight, ..., rating)``.

    The weights are a literal array exploded per row (no join), so all
    weights are ranked and evaluated in one job over the same fused rows.
    """
    ws = F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("weight")
    return (fused.select(ws, "*")
            .withColumn("rating", F.col("rev_rating") * F.col("weight") + F.col("rat_rating")))


def topk_lists(scores: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Top-k per user in a total order (score desc, item asc); short lists kept.

    ``(*by, user_id, pos, item_id, rating)``. Each user's window holds the
    union of two k-lists at most, so the partition size is bounded by 2k.
    """
    w = Window.partitionBy(*by, "user_id").orderBy(F.desc("rating"), F.asc("item_id"))
    return (scores.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)
            .select(*by, "user_id", "pos", "item_id", "rating"))


def topk_lists_running(scores: DataFrame, k: int) -> DataFrame:
    """Literal running-list form: ``collect_list`` over the default RANGE frame
    ordered by score desc, keeping rows whose running list has exactly k items.

    Peers (equal scores) enter together, so a tie across position k drops the
    user and a tie ending at k repeats the list once per peer; users with fewer
    than k candidates vanish. The list is returned as sorted ids joined by ','
    (order within peers is undefined). Kept to document that behaviour;
    :func:`topk_lists` is the default.

    Computed in O(k) per user rather than materialising a growing list on every
    row: a running count over the same RANGE frame is the running list's size.
    One aggregate per user (on the window's partitioning, no further shuffle)
    gathers the items with count <= k and counts the rows with count k (the
    peers of the last group); the list is then emitted once per such row.
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"))
    counted = scores.select("user_id", "item_id", F.count(F.lit(1)).over(w).alias("n"))
    per_user = counted.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") <= k, F.col("item_id")))),
                     ",").alias("items"),
        F.count(F.when(F.col("n") == k, 1)).cast("int").alias("ends"))
    return (per_user.filter(F.col("ends") > 0)
            .select("user_id", F.explode(F.array_repeat("items", F.col("ends"))).alias("items")))


def hybrid_lists(rating_recs: DataFrame, review_recs: DataFrame, weight: float,
                 k: int) -> DataFrame:
    """Explode both recommendation tables, fuse, and rebuild top-k lists (long)."""
    return topk_lists(fuse_scores(explode_recs(rating_recs), explode_recs(review_recs),
                                  weight), k)
