"""Deterministic hash buckets.

Spark's ``sample``/``randomSplit``/``sampleBy`` depend on how the input happens
to be partitioned: the same seed over another layout keeps other rows. A bucket
computed from the row's own key does not, needs no driver-side dictionary and
no join, and is evaluated inside whole-stage codegen.

``bucket(salt, cols)`` is ``md5('salt|c1|c2...')``, first 8 hex digits read as
an unsigned 32-bit number, modulo ``modulus``. ``bucket_sql`` is the same
expression in DuckDB syntax so an independent engine can check the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(salt: str, *cols: str | Column, modulus: int = 1000) -> Column:
    """Integer bucket in ``[0, modulus)`` for the row's key columns."""
    parts = [F.lit(str(salt))] + [_as_col(c).cast("string") for c in cols]
    digest = F.md5(F.concat_ws("|", *parts))
    word = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (word % F.lit(modulus)).cast("int")


def bucket_sql(salt: str, *cols: str, modulus: int = 1000) -> str:
    """DuckDB twin of :func:`bucket` (column names as SQL identifiers)."""
    parts = ", ".join([f"'{salt}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return (f"CAST((('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::BIGINT"
            f" % {modulus}) AS INTEGER)")
