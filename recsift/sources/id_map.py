"""Dense int ids for users and items whose ids are larger than an int or text.

Spark ML's ALS takes int ids. An id map gives every distinct id a number from
0 on, in order of the ids, is written once, joined in before preparation and
joined back after scoring.

Numbers come from a range-partitioned, sorted list of the distinct ids: the
place within a partition plus the sizes of the partitions before it, so no
task sees more than its partition (the window holds one row per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators.joins import bounded, materialize_keys

MAX_IDS = 2 ** 31 - 1


def id_map(rows: DataFrame, column: str) -> DataFrame:
    """``(id, dense)`` for the distinct non-null ids of ``column``: written once,
    one-to-one, dense from 0, ascending with the ids."""
    ids = rows.select(F.col(column).alias("id")).filter(F.col("id").isNotNull()).distinct()
    placed = materialize_keys(
        ids.repartitionByRange("id").sortWithinPartitions("id")
        .select("id", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # one row per partition of the id list
    dense = placed.join(F.broadcast(starts), "part").select("id", (F.col("start") + F.col("place")).alias("dense"))
    dense, n = bounded(dense)
    if n > MAX_IDS:
        raise ValueError(f"{n} distinct ids do not fit the model's int ids")
    return dense.select("id", F.col("dense").cast("int").alias("dense"))


def encode_ids(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by its dense number; null ids drop out."""
    keys = mapping.select(F.col("id").alias("_id"), F.col("dense").alias("_dense"))
    joined = rows.join(keys, rows[column] == keys["_id"])
    return joined.select(*[F.col("_dense").alias(c) if c == column else rows[c] for c in rows.columns])


def decode_ids(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """The inverse of :func:`encode_ids`."""
    keys = mapping.select(F.col("id").alias("_id"), F.col("dense").alias("_dense"))
    joined = rows.join(keys, rows[column] == keys["_dense"])
    return joined.select(*[F.col("_id").alias(c) if c == column else rows[c] for c in rows.columns])
