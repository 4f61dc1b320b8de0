"""Running totals over all rows without one task seeing them all."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def spread_of(salt: int, key: str) -> Column:
    """60 bits of the MD5 of a salt and a text column, as a long: an order that
    another engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(salt)), key)), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, group: list[str], order: list[Column], value: Column, out: str,
            spread: Column, n_rows: int) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in its
    ``group``, in order of ``spread`` (:func:`spread_of`), then ``order``.

    The hash's leading part cuts every group into slices, as many as the root
    of the rows; slice totals are summed up per group (one row a slice), and
    rows only within their slice. So a group of any share of the rows is
    spread over tasks, and no window holds more than about that root.
    """
    slices = max(1, math.isqrt(n_rows))
    cut = F.floor(spread.cast("double") / float(1 << 60) * slices).cast("long")
    df = df.withColumn("_slice", cut).withColumn("_value", value).withColumn("_spread", spread)
    totals = df.groupBy(*group, "_slice").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, "_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_slice").orderBy("_spread", *order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    part = df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = [part[g].eqNullSafe(starts[g]) for g in group] + [part["_slice"] == starts["_slice"]]
    joined = part.join(starts, same, "inner").withColumn(out, F.col("_start") + F.col("_inside"))
    return joined.select(*[part[c] for c in df.columns if c not in ("_slice", "_value", "_spread")], out)
