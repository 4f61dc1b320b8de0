"""Split quality report, row conservation and duplicate checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_report(splits: DataFrame) -> DataFrame:
    """Per split: rows, distinct users, distinct items (one grouped aggregate)."""
    return splits.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    )


def conservation(down: DataFrame, splits: DataFrame,
                 cols=("user_id", "item_id", "rating")) -> DataFrame:
    """Two-way set difference between the split input and the recombined splits.

    ``side = 'missing'``: in the input, in no split (the unobserved-item rows);
    ``side = 'extra'``: in a split but not in the input (should be empty).
    Both are distinct set differences (EXCEPT), planned as anti joins on all
    columns; the key includes the item, so a hot user spreads over tasks.
    """
    a = down.select(*cols)
    b = splits.select(*cols)
    return (a.subtract(b).withColumn("side", F.lit("missing"))
            .unionByName(b.subtract(a).withColumn("side", F.lit("extra"))))


def duplicate_pairs(rows: DataFrame) -> DataFrame:
    """(user, item) pairs seen more than once: ``(user_id, item_id, n)``."""
    return (rows.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def _pair_stats(df: DataFrame, prefix: str) -> DataFrame:
    """One pass over the (user, item) pairs: users, rows and duplicate pairs."""
    pairs = df.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.countDistinct("user_id").alias(f"{prefix}_users"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(f"{prefix}_rows"),
        F.count(F.when(F.col("n") > 1, 1)).alias(f"{prefix}_duplicates"))


def _split_stats(splits: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One pass over (split, user): rows and users of every split."""
    per_user = splits.groupBy("split", "user_id").agg(F.count(F.lit(1)).alias("n"))
    fields = []
    for name in names:
        mine = F.col("split") == name
        fields += [F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).cast("bigint")
                   .alias(f"{name}_rows"),
                   F.count(F.when(mine, 1)).alias(f"{name}_users")]
    return per_user.agg(*fields)


def _long(one_row: DataFrame) -> DataFrame:
    """A one-row frame of counts as ``(name, value)`` rows."""
    pairs = [x for c in one_row.columns for x in (F.lit(c), F.col(c).cast("bigint"))]
    return one_row.select(F.explode(F.create_map(*pairs)).alias("name", "value"))


def quality_report(full: DataFrame, down: DataFrame, splits: DataFrame,
                   cols=("user_id", "item_id", "rating")) -> DataFrame:
    """The whole quality check as one row (eager: the row is checkpointed).

    ``full`` is the interaction table, ``down`` the split input (zeros and low
    users removed, downsampled) and ``splits`` the split rows. Counts of users
    and rows at each stage, the user shares (``down_user_share`` should be the
    fraction, ``train_user_share`` 1, ``val_user_share`` and
    ``test_user_share`` about 0.2), the summed split row share, the two-way set
    differences (``missing`` are the unobserved-item rows, ``extra`` should be
    0) and the duplicate (user, item) pairs of each table.

    Each figure group is one aggregate pass: over the (user, item) pairs of
    each table, over (split, user), over the set differences. The aggregates
    are partial, so a hot user collapses map-side. Their one-row results are
    unioned as (name, value) rows and pivoted into one row, so each pass runs
    once. Each input is read by several passes, so pass written tables.
    """
    from recsift.session import checkpoint_dir

    names = ("train", "val", "test")
    diff = conservation(down, splits, cols).agg(
        F.count(F.when(F.col("side") == "missing", 1)).alias("missing"),
        F.count(F.when(F.col("side") == "extra", 1)).alias("extra"))
    parts = [_pair_stats(full, "full"), _pair_stats(down, "down"),
             _pair_stats(splits, "split"), _split_stats(splits, names), diff]
    order = ["full_users", "down_users", *[f"{n}_users" for n in names],
             "full_rows", "down_rows", *[f"{n}_rows" for n in names], "split_rows",
             "missing", "extra", "full_duplicates", "down_duplicates", "split_duplicates"]
    longs = _long(parts[0])
    for p in parts[1:]:
        longs = longs.unionByName(_long(p))
    wide = longs.groupBy().pivot("name", order).agg(F.first("value")).select(*order)
    share = lambda a, b: F.round(F.col(a).cast("double") / F.col(b), 9)
    out = wide.select(
        "*", share("down_users", "full_users").alias("down_user_share"),
        *[share(f"{n}_users", "down_users").alias(f"{n}_user_share") for n in names],
        share("split_rows", "down_rows").alias("split_row_share"))
    checkpoint_dir(out.sparkSession)
    return out.checkpoint(eager=True)
