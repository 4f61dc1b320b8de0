"""Column expressions shared by operators and their SQL oracles."""

from recsift.functions.hashing import bucket, bucket_sql
from recsift.functions.ranking import (
    average_precision,
    dcg_at,
    ideal_dcg_at,
    precision_at,
)

__all__ = ["bucket", "bucket_sql", "average_precision", "dcg_at", "ideal_dcg_at",
           "precision_at"]
