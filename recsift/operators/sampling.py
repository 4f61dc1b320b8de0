"""User-level downsampling by hash bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from recsift.functions.hashing import bucket

# Resolution of the downsample fraction: 1 / DOWNSAMPLE_MODULUS.
DOWNSAMPLE_MODULUS = 10_000


def check_fraction(fraction: float) -> None:
    if not (0 < fraction <= 1):
        raise ValueError("downsample fraction must be in (0, 1]")
    if fraction * DOWNSAMPLE_MODULUS < 1:
        raise ValueError(f"fraction below the bucket resolution 1/{DOWNSAMPLE_MODULUS}")


def user_share(seed: int) -> Column:
    """Bucket in [0, DOWNSAMPLE_MODULUS) of the row's user for the downsample."""
    return bucket(f"{seed}d", "user_id", modulus=DOWNSAMPLE_MODULUS)


def downsample_users(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """Keep a ``fraction`` of the distinct users and **all** of their rows.

    A predicate on the user's hash bucket: no distinct, no join, no shuffle,
    independent of the input layout, and the users kept at a smaller fraction
    are a subset of those kept at a larger one. ``fraction == 1`` returns the
    input unchanged.
    """
    check_fraction(fraction)
    if fraction == 1:
        return df
    return df.filter(user_share(seed) < int(round(fraction * DOWNSAMPLE_MODULUS)))
