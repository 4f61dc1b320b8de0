"""Joins against a derived key table, broadcast only behind a size check.

A key table derived from the data (active users, put-back users, unobserved
items) grows with the data, so it is never broadcast blindly. It is written
once as a reliable checkpoint under ``spark.checkpoint.dir`` (the aggregate
behind it runs once, a lost executor re-reads files instead of recomputing it,
and no executor memory stays pinned), counted, and broadcast only when the
count is at most ``recsift.broadcast.maxRows``. Otherwise the join stays a
shuffle join, where adaptive execution splits a hot key's partition on the
large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.session import checkpoint_dir

DEFAULT_MAX_ROWS = 2_000_000


def max_broadcast_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("recsift.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))


def _hint(keys: DataFrame, n: int, max_rows: int | None) -> DataFrame:
    limit = max_broadcast_rows(keys) if max_rows is None else max_rows
    return F.broadcast(keys) if n <= limit else keys


def materialize_keys(keys: DataFrame) -> DataFrame:
    """Write a derived key table once to the shared checkpoint folder (eager)."""
    checkpoint_dir(keys.sparkSession)
    return keys.checkpoint(eager=True)


def bounded(keys: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, int]:
    """Checkpoint ``keys``, count it, and hint a broadcast when the count is bounded."""
    keys = materialize_keys(keys)
    n = keys.count()
    return _hint(keys, n, max_rows), n


def keep_keys(df: DataFrame, decisions: DataFrame, on: str, keep_col: str = "keep",
              max_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key has ``keep_col`` true in ``decisions`` (one row per key).

    ``decisions`` is checkpointed and both sides are counted in one pass; the
    rows are then joined with the smaller side only: a semi join with the
    kept keys or an anti join with the dropped ones. Rows with a null key go.
    """
    decisions = materialize_keys(decisions.select(on, keep_col))
    sizes = decisions.agg(
        F.count(F.when(F.col(keep_col), 1)).alias("n_keep"),
        F.count(F.when(~F.col(keep_col), 1)).alias("n_drop")).first()
    n_keep, n_drop = sizes["n_keep"], sizes["n_drop"]
    df = df.filter(F.col(on).isNotNull())  # a null key is in no key set, on every branch
    if n_drop == 0:
        return df
    if n_drop < n_keep:
        drop = decisions.filter(~F.col(keep_col)).select(on)
        return df.join(_hint(drop, n_drop, max_rows), on, "left_anti")
    keep = decisions.filter(F.col(keep_col)).select(on)
    return df.join(_hint(keep, n_keep, max_rows), on, "left_semi")


def attach_keys(df: DataFrame, keys: DataFrame, on: str, max_rows: int | None = None,
                **defaults) -> DataFrame:
    """Left join ``keys`` (one row per key, few columns) onto ``df``.

    Columns of ``keys`` missing for a row take ``defaults[name]``. When the
    key table is empty the join is skipped altogether.
    """
    keys_b, n = bounded(keys, max_rows)
    extra = [c for c in keys.columns if c != on]
    if n == 0:
        return df.select("*", *[F.lit(defaults.get(c)).alias(c) for c in extra])
    out = df.join(keys_b, on, "left")
    for c in extra:
        if c in defaults:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(defaults[c])))
    return out
