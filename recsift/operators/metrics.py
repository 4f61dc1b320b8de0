"""Evaluation: eval users, relevant labels, MAP / NDCG@k / precision@k.

All metrics come from one DataFrame pass: the long prediction list is joined
with the relevant (user, item) pairs to flag hits, each user's hit positions
(at most k of them) are gathered, and the formulas in
:mod:`recsift.functions.ranking` turn them into per-user values that are then
averaged. No RDD, no Python lambda, no per-user label array: the relevant set
stays in rows, so a user with a huge history is never gathered into one list.

As in the original evaluation, a user counts only when it has both a
prediction list and at least one relevant item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.functions.ranking import average_precision, dcg_at, ideal_dcg_at, precision_at
from recsift.operators.filters import relevant

ROUND = 9


def eval_users(split_rows: DataFrame) -> DataFrame:
    return split_rows.select("user_id").distinct()


def true_labels(split_rows: DataFrame, threshold: int = 3) -> DataFrame:
    """Relevant (user, item) pairs: ``rating > threshold``, as rows."""
    return relevant(split_rows, threshold).select("user_id", "item_id").distinct()


# Items in one array of a user's labels, and ids in one stretch of the numbering.
LABEL_CHUNK = 1024


def label_arrays(labels: DataFrame, chunk: int = LABEL_CHUNK) -> DataFrame:
    """Relevant items as arrays: ``(user_id, chunk, items)``, a user's item ids
    ascending, ``chunk`` of them to an array (the last one has the rest).

    ``labels`` is distinct ``(user_id, item_id)``. A user's items are numbered
    by stretches of :data:`LABEL_CHUNK` consecutive ids: inside a stretch by a
    window of at most that many rows, and from the stretches' counts. So no
    window, array or task grows with one user's history. Rows with a null user
    or item do not count; an empty table gives an empty result.
    """
    if chunk < 1:
        raise ValueError("chunk must be at least 1")
    rows = labels.select("user_id", "item_id").dropna() \
        .withColumn("_stretch", F.floor(F.col("item_id") / LABEL_CHUNK))
    inside = Window.partitionBy("user_id", "_stretch").orderBy("item_id")
    rows = rows.withColumn("_nth", F.row_number().over(inside) - 1)
    before = Window.partitionBy("user_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("user_id", "_stretch").agg(F.count(F.lit(1)).alias("_n")) \
        .select("user_id", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = rows.join(starts, ["user_id", "_stretch"]) \
        .withColumn("chunk", F.floor((F.col("_start") + F.col("_nth")) / chunk).cast("int"))
    return at.groupBy("user_id", "chunk").agg(F.sort_array(F.collect_list("item_id")).alias("items"))


def per_user_metrics(preds: DataFrame, labels: DataFrame, k: int,
                     by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, user_id, n_pred, n_labels, ap, ndcg, precision)`` per evaluated user.

    ``preds`` is ``(*by, user_id, pos, item_id)`` with 1-based positions, one
    list per ``(*by, user_id)``; ``labels`` is distinct ``(user_id, item_id)``.
    ``by`` evaluates several list variants (e.g. fusion weights) in one pass.
    """
    flagged = preds.select(*by, "user_id", "pos", "item_id").join(
        labels.select("user_id", "item_id", F.lit(True).alias("hit")), ["user_id", "item_id"], "left")
    lists = flagged.groupBy(*by, "user_id").agg(
        F.count(F.lit(1)).alias("n_pred"),
        F.sort_array(F.collect_list(F.when(F.col("hit"), F.col("pos")))).alias("hits"))
    n_labels = labels.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_labels"))
    both = lists.join(n_labels, "user_id")
    return both.select(
        *by, "user_id", "n_pred", "n_labels",
        average_precision(F.col("hits"), F.col("n_labels")).alias("ap"),
        (dcg_at(F.col("hits"), k) / ideal_dcg_at(F.col("n_labels"), k)).alias("ndcg"),
        precision_at(F.col("hits"), k).alias("precision"),
    )


def ranking_metrics(preds: DataFrame, labels: DataFrame, k: int,
                    by: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``by`` group: ``map, ndcg_at_k, precision_at_k,
    n_users_evaluated, n_users_with_labels``."""
    pu = per_user_metrics(preds, labels, k, by).groupBy(*by).agg(
        F.round(F.avg("ap"), ROUND).alias("map"),
        F.round(F.avg("ndcg"), ROUND).alias("ndcg_at_k"),
        F.round(F.avg("precision"), ROUND).alias("precision_at_k"),
        F.count(F.lit(1)).alias("n_users_evaluated"))
    n_lab = labels.agg(F.countDistinct("user_id").alias("n_users_with_labels"))
    return pu.select("*", n_lab.scalar().alias("n_users_with_labels"))
