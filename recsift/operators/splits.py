"""Train / validation / test split by user, with a per-user holdout.

Semantics:

1. Users are divided 60 / 20 / 20 into train, val and test *roles* by a hash
   bucket of the user.
2. About half of each val or test user's rows are *held out* (a row-level
   hash bucket on user and item: independent per row, not an exact half).
   Everything not held out goes to train.
3. Put-back: a val/test user with no row left in train gets all its held-out
   rows moved to train (a model cannot rank for an unseen user).
4. Items never seen in the final train are dropped from val and test.
   Put-back runs before item visibility.

The whole split is one tagged pass over the rows, with no set differences
and no per-role joins: ``role`` and ``held`` are row expressions, put-back
and item visibility are one aggregate each followed by a join against a
(usually tiny) key table that is broadcast only when its count is bounded.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.functions.hashing import bucket
from recsift.operators.joins import attach_keys, bounded, keep_keys
from recsift.session import checkpoint_dir

TRAIN, VAL, TEST = "train", "val", "test"


@dataclass(frozen=True)
class SplitSpec:
    seed: int = 42
    train_share: int = 600  # per mille of users
    val_share: int = 200    # per mille of users; test gets the rest
    holdout: int = 500      # per mille of a val/test user's rows held out

    def user_bucket(self) -> Column:
        return bucket(f"{self.seed}s", "user_id")

    def role(self, b: Column | None = None) -> Column:
        """The role of the user's bucket ``b``, which is hashed here by default."""
        b = self.user_bucket() if b is None else b
        return (F.when(b < self.train_share, F.lit(TRAIN))
                .when(b < self.train_share + self.val_share, F.lit(VAL))
                .otherwise(F.lit(TEST)))

    def held(self) -> Column:
        """Row is held out: its user is not a train user and its row bucket is low."""
        return (F.col("role") != TRAIN) & (bucket(f"{self.seed}h", "user_id", "item_id")
                                           < self.holdout)


def assign_roles(df: DataFrame, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """Attach ``role`` to every row by the user's bucket (no distinct, no join).
    The bucket is a column of its own, so that a row's user is hashed once."""
    return df.withColumn("_bucket", spec.user_bucket()).withColumn("role", spec.role(F.col("_bucket"))).drop("_bucket")


def tag_holdout(df: DataFrame, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """``role`` plus ``held``: whether a val/test row is held out of train."""
    return assign_roles(df, spec).withColumn("held", spec.held())


def _tagged_once(tagged: DataFrame) -> DataFrame:
    """Tagged rows written once to the shared checkpoint folder: put-back, item
    visibility and the result read them, and each would hash every row again."""
    from recsift.sources.store import materialize

    return materialize(tagged, f"{checkpoint_dir(tagged.sparkSession)}/recsift-tagged/{uuid.uuid4().hex}", sort_by=())


def train_rows(tagged: DataFrame) -> DataFrame:
    """Rows that reach train before put-back: train users' rows and the
    non-held rows of val/test users (the complement of the holdout)."""
    return tagged.filter(~F.col("held"))


def unseen_users(tagged: DataFrame) -> DataFrame:
    """Val/test users whose rows are all held out: ``(user_id, put_back)``. No row
    of a train user is held, so there is no filter on the role, which would hash
    each row's user twice more."""
    return (tagged.groupBy("user_id")
            .agg(F.min(F.col("held").cast("int")).alias("all_held"))
            .filter(F.col("all_held") == 1)
            .select("user_id", F.lit(True).alias("put_back")))


def put_back(tagged: DataFrame) -> DataFrame:
    """Attach ``put_back`` and the post-put-back ``split`` to tagged rows."""
    flagged = attach_keys(tagged, unseen_users(tagged), "user_id", put_back=False)
    return flagged.withColumn(
        "split", F.when(~F.col("held") | F.col("put_back"), F.lit(TRAIN)).otherwise(F.col("role")))


def item_visibility(df: DataFrame) -> DataFrame:
    """``(item_id, keep)``: whether the item has at least one train row."""
    return df.groupBy("item_id").agg(
        F.max((F.col("split") == TRAIN).cast("int")).alias("seen")
    ).select("item_id", (F.col("seen") == 1).alias("keep"))


def item_visibility_rows(df: DataFrame, keep: bool = True) -> DataFrame:
    """Rows whose item is (``keep=True``) or is not (``keep=False``) seen in train."""
    vis = item_visibility(df)
    items, _ = bounded(vis.filter(F.col("keep") == keep).select("item_id"))
    return df.join(items, "item_id", "left_semi")


def drop_unobserved_items(df: DataFrame) -> DataFrame:
    """Drop val/test rows whose item has no train row.

    An unobserved item has no train row at all, so dropping every row of it
    drops exactly its held-out rows; the join goes against the smaller of the
    seen / unseen item sets.
    """
    return keep_keys(df, item_visibility(df), "item_id")


def split(df: DataFrame, spec: SplitSpec = SplitSpec(), rm_unobserved: bool = True) -> DataFrame:
    """All steps; returns the rows with a ``split`` column (train / val / test).

    With ``rm_unobserved=False`` there is no put-back and no item removal:
    held rows keep their role and everything else is train.
    """
    tagged = tag_holdout(df, spec)
    if not rm_unobserved:
        return tagged.withColumn(
            "split", F.when(F.col("held"), F.col("role")).otherwise(F.lit(TRAIN)))
    return drop_unobserved_items(put_back(_tagged_once(tagged)))


def split_view(splits: DataFrame, which: str, cols=("user_id", "item_id", "rating")) -> DataFrame:
    """One split as the core triple (a filter, not a copy)."""
    return splits.filter(F.col("split") == which).select(*cols)
