"""Row filters: placeholder ratings, relevance, low-activity users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.joins import keep_keys


def remove_zeros(df: DataFrame) -> DataFrame:
    """Drop placeholder ratings (``rating > 0``; NULL ratings drop too).
    A plain predicate: it reaches the Parquet scan as a pushed filter."""
    return df.filter(F.col("rating") > 0)


def relevant(df: DataFrame, threshold: int = 3) -> DataFrame:
    """Relevant interactions: ``rating > threshold`` (strict)."""
    return df.filter(F.col("rating") > threshold)


def user_counts(df: DataFrame) -> DataFrame:
    """``(user_id, n)``; partial aggregation collapses a hot user map-side."""
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def check_threshold(threshold: int) -> None:
    if not isinstance(threshold, int) or isinstance(threshold, bool) or threshold < 0:
        raise ValueError("low-user threshold must be an int >= 0")


def remove_low_users(df: DataFrame, threshold: int = 10) -> DataFrame:
    """Keep users with **more than** ``threshold`` rows; 0 disables the filter.

    Per-user counts come from a partial aggregate. The rows are then joined
    with the smaller of {kept users, dropped users}, broadcast when bounded, so
    the interaction rows are not shuffled for the filter.
    """
    check_threshold(threshold)
    if threshold == 0:
        return df
    decisions = user_counts(df).select("user_id", (F.col("n") > threshold).alias("keep"))
    return keep_keys(df, decisions, "user_id")
