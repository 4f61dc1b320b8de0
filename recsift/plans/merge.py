"""New interactions merged into an existing split.

Downsample, roles and holdout are hashes of a row's own keys, so a new row never
moves another one by chance. It can only change what is decided by counts: its
user's activity and put-back, and the visibility of items whose train rows come
or go. The split at ``path`` therefore keeps, next to its rows, a state row per
user (rows, whether all are held) and per item (train rows), and lays the rows out
in buckets of users. A merge

* adds the delta's counts to the users' state,
* writes the buckets of the delta's users anew, with those users' new actions
  (the other buckets' files are not touched and not read),
* adds the difference of these buckets' train rows to the items' state.

Rows of low-activity users stay in the table, marked, since a later delta may
make the user active; items without train rows are left out on reading, so an
item that turns visible or invisible rewrites nothing. After any deltas,
:func:`read_split` equals ``prepare`` over all rows at once.

Every merge is a commit (:mod:`recsift.sources.commits`): readers see whole
versions only, of two merges at the same time the second starts again from the
first's version, and a delta that is merged again under its id changes nothing and
is not read. Else ``delta`` is read once: its tagged rows are written beside the
checkpoints until the merge is done, since counts, range bounds and rows take them
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recsift.functions.hashing import bucket
from recsift.operators.filters import remove_zeros
from recsift.operators.joins import attach_keys, keep_keys
from recsift.operators.sampling import downsample_users
from recsift.operators.splits import TRAIN, tag_holdout
from recsift.plans.prepare import OUT_COLS, PrepareSpec, user_action
from recsift.session import checkpoint_dir
from recsift.sources.commits import Commit, commit, commits, new_attempt, remove
from recsift.sources.store import materialize

_ROW = ["user_id", "item_id", "rating", "is_reviewed", "role", "held", "bucket"]


def _head(spark: SparkSession, path: str) -> Commit | None:
    """The newest version. One whose files are gone is an error: an older version
    would lose deltas without a word."""
    versions = commits(spark, path)
    if not versions:
        return None
    head = versions[-1]
    used = {head.attempt, *head.notes["buckets"].values()}
    lost = [c.attempt for c in versions if c.attempt in used and not c.intact(spark)]
    if lost:
        raise RuntimeError(f"files of {', '.join(lost)} at {path} are gone; rebuild the split")
    return head


def _bucket_rows(spark: SparkSession, head: Commit, only=None) -> DataFrame:
    folders = [f"{head.path}/{attempt}/rows/part={b}" for b, attempt in head.notes["buckets"].items()
               if only is None or int(b) in only]
    if not folders:
        return spark.createDataFrame([], StructType.fromJson(head.notes["schema"]))
    return spark.read.parquet(*folders)


def _train_rows(rows: DataFrame, sign: int) -> DataFrame:
    n = F.when(F.col("split") == TRAIN, F.lit(sign)).otherwise(F.lit(0)).cast("bigint")
    return rows.groupBy("item_id").agg(F.sum(n).alias("n_train"))


def _key(spec: PrepareSpec, buckets: int) -> str:
    return f"{spec}, buckets={buckets}"


def merge_delta(delta: DataFrame, path: str, spec: PrepareSpec, delta_id: str,
                buckets: int = 64) -> Commit:
    """Merge ``delta`` into the split at ``path`` (a first one starts it) and
    return the version that holds it. ``buckets`` bounds the part of the rows that
    a small delta rewrites; a user's bucket is written by as many tasks as it needs."""
    spec.check()
    if not spec.rm_unobserved:
        raise ValueError("a split that keeps unobserved rows is not kept for reuse")
    spark = delta.sparkSession
    rows = remove_zeros(delta) if spec.rm_zeros else delta
    rows = downsample_users(rows, spec.fraction, spec.seed)
    tagged = tag_holdout(rows, spec.split_spec()) \
        .withColumn("bucket", bucket(f"{spec.seed}m", "user_id", modulus=buckets)).select(*_ROW)
    folder = f"{checkpoint_dir(spark)}/recsift/deltas/{new_attempt()}"
    try:
        while True:
            head = _head(spark, path)
            if head and head.notes["spec"] != _key(spec, buckets):
                raise ValueError(f"the split at {path} has other parameters: {head.notes['spec']}")
            if head and delta_id in head.notes["deltas"]:
                return head
            tagged = materialize(tagged, folder, sort_by=())  # written in the first round
            counts = tagged.groupBy("user_id", "bucket").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.col("held").cast("int")).alias("all_held"))
            touched = {r.bucket for r in tagged.select("bucket").distinct().collect()}  # at most ``buckets``
            done = _write(spark, path, head, tagged, counts, touched, spec, delta_id, _key(spec, buckets))
            if done:
                return done
    finally:
        remove(spark, folder)


def _write(spark, path, head, tagged, counts, touched, spec, delta_id, key) -> Commit | None:
    attempt = new_attempt()
    folder = f"{path}/{attempt}"
    if head:
        counts = spark.read.parquet(f"{head.folder}/users").unionByName(counts)
    users = materialize(counts.groupBy("user_id", "bucket").agg(
        F.sum("n").alias("n"), F.min("all_held").alias("all_held")),
        f"{folder}/users", sort_by=("bucket", "user_id"))

    before = _bucket_rows(spark, head, touched) if head else None
    merged = before.drop("split").unionByName(tagged) if head else tagged
    turned = users.filter(F.col("bucket").isin(sorted(touched))) \
        .select("user_id", user_action(spec).alias("action")).filter(F.col("action").isNotNull())
    joined = attach_keys(merged, turned, "user_id")
    is_ = lambda action: F.coalesce(F.col("action") == action, F.lit(False))
    out = joined.withColumn("split", F.when(is_("drop"), F.lit(None).cast("string"))
                            .when(~F.col("held") | is_("put_back"), F.lit(TRAIN))
                            .otherwise(F.col("role"))).select(*_ROW, "split")
    buckets = dict(head.notes["buckets"]) if head else {}
    items = [spark.read.parquet(f"{head.folder}/items")] if head else []
    if touched:
        order = ["bucket", "user_id", "item_id"]  # a user's rows may lie in several files
        out.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.col("bucket")) \
            .write.partitionBy("part").parquet(f"{folder}/rows")
        buckets.update({str(b): attempt for b in touched})
        after = spark.read.parquet(*[f"{folder}/rows/part={b}" for b in sorted(touched)])
        items += [_train_rows(after, 1)] + ([_train_rows(before, -1)] if head else [])
    state = items[0] if items else _train_rows(out, 1)
    for more in items[1:]:
        state = state.unionByName(more)
    materialize(state.groupBy("item_id").agg(F.sum("n_train").alias("n_train")),
                f"{folder}/items", sort_by=("item_id",))
    return commit(spark, path, attempt, head.number + 1 if head else 0, {
        "buckets": buckets, "deltas": (head.notes["deltas"] if head else []) + [delta_id],
        "spec": key, "schema": out.schema.jsonValue()})


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the split at ``path``, as ``prepare`` returns it."""
    head = _head(spark, path)
    if head is None:
        raise FileNotFoundError(f"no split at {path}")
    rows = _bucket_rows(spark, head).filter(F.col("split").isNotNull())
    seen = spark.read.parquet(f"{head.folder}/items").select("item_id", (F.col("n_train") > 0).alias("keep"))
    return keep_keys(rows, seen, "item_id").select(*OUT_COLS)
