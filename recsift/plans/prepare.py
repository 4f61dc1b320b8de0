"""Preparation: zeros -> low-activity users -> downsample -> split.

:func:`prepare` runs the whole preparation as one tagged plan. The
downsample is a predicate on the user's hash bucket and the low-user filter
keeps or drops whole users, so the downsample runs first, right over the
scan, and the two filters commute with it. The low-user count and the
"all rows held out" put-back test are both per-user aggregates over the same
rows, so one grouped aggregate yields both; only the exceptional users
(dropped or put back) are joined back.

:func:`prepare_stepwise` chains the individual operators in the original order;
the tests check that both give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.operators.filters import check_threshold, remove_low_users, remove_zeros
from recsift.operators.joins import attach_keys, bounded, materialize_keys, max_broadcast_rows
from recsift.operators.sampling import DOWNSAMPLE_MODULUS, check_fraction, downsample_users, user_share
from recsift.operators.splits import TRAIN, SplitSpec, drop_unobserved_items, split, tag_holdout
from recsift.sources.commits import load_or_compute
from recsift.sources.interactions import interactions, interactions_table
from recsift.sources.store import artefact_path, source_key

OUT_COLS = ["user_id", "item_id", "rating", "is_reviewed", "split"]


@dataclass(frozen=True)
class PrepareSpec:
    fraction: float = 1.0
    seed: int = 42
    low_threshold: int = 10
    rm_zeros: bool = True
    rm_unobserved: bool = True
    shares: SplitSpec | None = field(default=None)

    def split_spec(self) -> SplitSpec:
        return self.shares or SplitSpec(seed=self.seed)

    def check(self) -> None:
        check_fraction(self.fraction)
        check_threshold(self.low_threshold)


def user_action(spec: PrepareSpec) -> Column:
    """What becomes of a user with ``n`` rows, ``all_held`` or not: ``drop``
    (low activity), ``put_back`` (all rows held out) or null."""
    action = F.when((F.col("n") <= spec.low_threshold) & F.lit(spec.low_threshold > 0),
                    F.lit("drop"))
    if spec.rm_unobserved:
        action = action.when((F.col("all_held") == 1) & (spec.split_spec().role() != TRAIN),
                             F.lit("put_back"))
    return action


def _tagged_users(rows: DataFrame, spec: PrepareSpec) -> DataFrame:
    """Rows with role / held, after dropping low users and marking put-backs."""
    sspec = spec.split_spec()
    tagged = tag_holdout(rows, sspec)
    if spec.low_threshold == 0 and not spec.rm_unobserved:
        return tagged.withColumn("action", F.lit(None).cast("string"))
    stats = tagged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("held").cast("int")).alias("all_held"))
    exceptions = stats.select("user_id", user_action(spec).alias("action")).filter(F.col("action").isNotNull())
    joined = attach_keys(tagged, exceptions, "user_id")
    return joined.filter(F.col("action").isNull() | (F.col("action") != "drop"))


def prepare(df: DataFrame, spec: PrepareSpec = PrepareSpec()) -> DataFrame:
    """Interactions -> ``(user_id, item_id, rating, is_reviewed, split)``."""
    spec.check()
    rows = remove_zeros(df) if spec.rm_zeros else df
    rows = downsample_users(rows, spec.fraction, spec.seed)
    kept = _tagged_users(rows, spec)
    if not spec.rm_unobserved:
        out = kept.withColumn("split", F.when(F.col("held"), F.col("role")).otherwise(F.lit(TRAIN)))
        return out.select(*OUT_COLS)
    moved = F.coalesce(F.col("action") == "put_back", F.lit(False))
    out = kept.withColumn(
        "split", F.when(~F.col("held") | moved, F.lit(TRAIN)).otherwise(F.col("role")))
    return drop_unobserved_items(out).select(*OUT_COLS)


def prepare_stepwise(df: DataFrame, spec: PrepareSpec = PrepareSpec()) -> DataFrame:
    """The same preparation as a chain of the individual operators."""
    spec.check()
    rows = remove_zeros(df) if spec.rm_zeros else df
    rows = remove_low_users(rows, spec.low_threshold)
    rows = downsample_users(rows, spec.fraction, spec.seed)
    return split(rows, spec.split_spec(), spec.rm_unobserved).select(*OUT_COLS)


def prepared_table(spark: SparkSession, sf_dir: str, spec: PrepareSpec = PrepareSpec()) -> DataFrame:
    """Split persistence: the prepared table written once under the shared
    checkpoint folder (partitioned by split, so reading one split prunes the
    rest), keyed by every preparation parameter and the source. Saving is
    refused for the variants that keep zeros or unobserved rows, which are
    never meant to be reused."""
    if not (spec.rm_zeros and spec.rm_unobserved):
        return prepare(interactions(spark, sf_dir), spec)
    path = artefact_path(spark, "splits", source_key(spark, sf_dir),
                         fraction=spec.fraction, seed=spec.seed,
                         low=spec.low_threshold, shares=spec.split_spec())
    return load_or_compute(spark, path, lambda: prepare(interactions_table(spark, sf_dir), spec),
                           partition_by="split")


def fraction_table(df: DataFrame, seed: int = 42, low_threshold: int = 10) -> DataFrame:
    """Splits for every downsample fraction at once, as one table.

    ``(user_id, item_id, rating, is_reviewed, split, share)``: ``share`` is the
    smallest downsample bucket at which the row exists, so the prepared split
    at fraction ``f`` is ``at_fraction(table, f)``, a filter. A user enters
    the sample at every fraction above its hash share (the users of a
    smaller fraction are a subset of those of a larger one). Low-user
    removal and put-back are per-user and do not depend on the fraction;
    only item visibility does: a held-out row survives once some user with
    the item in train has entered, i.e. above the item's smallest train share.
    """
    spec = PrepareSpec(fraction=1.0, seed=seed, low_threshold=low_threshold)
    kept = _tagged_users(remove_zeros(df), spec)
    moved = F.coalesce(F.col("action") == "put_back", F.lit(False))
    rows = kept.select(
        "user_id", "item_id", "rating", "is_reviewed", user_share(seed).alias("share"),
        F.when(~F.col("held") | moved, F.lit(TRAIN)).otherwise(F.col("role")).alias("split"))
    first_seen, n_items = bounded(rows.filter(F.col("split") == TRAIN).groupBy("item_id")
                                  .agg(F.min("share").alias("item_share")))
    visible = F.col("item_share").isNotNull()
    entered = F.when(F.col("split") == TRAIN, F.col("share")) \
        .otherwise(F.greatest("share", "item_share"))
    if n_items <= max_broadcast_rows(rows):
        # bounded item table: one pass, every row meets the broadcast table
        joined = rows.join(first_seen, "item_id", "left")
        return (joined.filter((F.col("split") == TRAIN) | visible)
                .withColumn("share", entered).select(*OUT_COLS, "share"))
    # beyond the bound only the held rows are shuffled by item; train rows pass through
    held = (rows.filter(F.col("split") != TRAIN).join(first_seen, "item_id", "left")
            .filter(visible).withColumn("share", entered).select(*OUT_COLS, "share"))
    return rows.filter(F.col("split") == TRAIN).select(*OUT_COLS, "share").unionByName(held)


def at_fraction(table: DataFrame, fraction: float) -> DataFrame:
    """The prepared split at ``fraction`` from a :func:`fraction_table`."""
    check_fraction(fraction)
    return (table.filter(F.col("share") < int(round(fraction * DOWNSAMPLE_MODULUS)))
            .select(*OUT_COLS))


def save_fraction_splits(spark: SparkSession, sf_dir: str, seed: int = 42,
                         low_threshold: int = 10) -> DataFrame:
    """Bulk split job: every fraction's split in one written table (one job),
    partitioned by split; read a fraction back with :func:`at_fraction`."""
    path = artefact_path(spark, "fraction_splits", source_key(spark, sf_dir),
                         seed=seed, low=low_threshold)
    return load_or_compute(
        spark, path, lambda: fraction_table(interactions_table(spark, sf_dir), seed, low_threshold),
        partition_by="split")


def split_fractions(df: DataFrame, fractions=(0.01, 0.05, 0.25, 1.0), seed: int = 42,
                    low_threshold: int = 10) -> DataFrame:
    """Split sizes at several fractions in one pass: ``(fraction, split, n_rows, n_users)``.

    The :func:`fraction_table` is computed once, into row counts per
    (user, split, share), written to the shared checkpoint folder (a partial
    aggregate: a hot user collapses map-side). Both histograms (rows and
    users by share) come from that table, and only they are expanded per
    fraction.
    """
    for f in fractions:
        check_fraction(f)
    per = materialize_keys(fraction_table(df, seed, low_threshold)
                           .groupBy("user_id", "split", "share").agg(F.count(F.lit(1)).alias("n")))
    row_hist = per.groupBy("split", "share").agg(F.sum("n").alias("n"))
    user_hist = (per.groupBy("user_id", "split").agg(F.min("share").alias("share"))
                 .groupBy("split", "share").agg(F.count(F.lit(1)).alias("u")))
    hist = row_hist.join(user_hist, ["split", "share"], "full").na.fill(0, ["n", "u"])
    cuts = F.explode(F.array(*[F.struct(F.lit(float(f)).alias("fraction"),
                                        F.lit(int(round(f * DOWNSAMPLE_MODULUS))).alias("cut"))
                               for f in fractions])).alias("c")
    return (hist.select("*", cuts).filter(F.col("share") < F.col("c.cut"))
            .groupBy(F.col("c.fraction").alias("fraction"), "split")
            .agg(F.sum("n").cast("bigint").alias("n_rows"), F.sum("u").cast("bigint").alias("n_users")))
