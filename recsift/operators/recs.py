"""Recommendation lists: ALS fit / top-k, list reshaping, popularity lists.

A recommendation table is ``(user_id, recommendations array<struct<item_id:int,
rating:float>>)``, best first, in the layout of ``ALSModel.recommendForUserSubset``.
The long form is ``(user_id, pos, item_id, rating)`` with 1-based ``pos``; it is
what :func:`recommend_long` computes (exact top-k by blocks of users and items
that meet in a cogroup) and what the evaluation reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.functions.hashing import bucket


# User and item blocks of a factorisation by default. The block layout decides
# the seeded initial factors, so it is a parameter of the model, the same in
# every session; a wide cluster sets it (``ALSSpec.blocks``) to its cores.
DEFAULT_BLOCKS = 16


# Ratings up to which Spark ML fits its model itself.
ML_RATINGS = 1_000_000


@dataclass(frozen=True)
class ALSSpec:
    rank: int = 10
    reg: float = 1.0
    implicit: bool = False
    max_iter: int = 10
    alpha: float = 1.0
    seed: int = 42
    block_size: int = 4096
    # User and item blocks of the factorisation; each block is one task per
    # half-iteration, so this is the fit's parallelism.
    blocks: int = DEFAULT_BLOCKS
    # Iterations between factor checkpoints to the shared folder: a lost
    # executor then recomputes at most this many iterations.
    checkpoint_every: int = 5
    # "ml": Spark ML's model; "gram": :mod:`recsift.operators.gram_als`, the same
    # equations with a hot user's or item's ratings spread over tasks.
    solver: str = "ml"
    # Up to so many ratings Spark ML fits the "ml" model itself; of more,
    # :mod:`recsift.operators.read_als` does the same half-iterations from the same
    # start and shuffles no factors. None: always Spark ML.
    ml_ratings: int | None = ML_RATINGS

    def __post_init__(self):
        if self.solver not in ("ml", "gram"):
            raise ValueError(f"unknown solver {self.solver!r}")

    @property
    def model_type(self) -> str:
        return "implicit" if self.implicit else "explicit"

    @property
    def rating_col(self) -> str:
        return "is_reviewed" if self.implicit else "rating"

    def estimator(self):
        from pyspark.ml.recommendation import ALS

        return ALS(rank=self.rank, regParam=self.reg, maxIter=self.max_iter,
                   implicitPrefs=self.implicit, alpha=self.alpha, seed=self.seed,
                   userCol="user_id", itemCol="item_id", ratingCol=self.rating_col,
                   coldStartStrategy="drop", blockSize=self.block_size,
                   numUserBlocks=self.blocks, numItemBlocks=self.blocks,
                   checkpointInterval=self.checkpoint_every)


def fit_als(train: DataFrame, spec: ALSSpec = ALSSpec(), path: str | None = None):
    """Fit (or load the saved fit at ``path``) an ALS model.

    Explicit models fit ``rating``; implicit models fit the review flag, zero
    rows included so both models see the same users and items.
    """
    from recsift.session import checkpoint_dir
    from recsift.sources.store import fit_or_load_als, fit_or_load_factors, model_exists

    checkpoint_dir(train.sparkSession)  # ALS cuts its iteration lineage there
    if spec.solver == "gram":
        from recsift.operators.gram_als import fit_gram_als

        return fit_or_load_factors(lambda: fit_gram_als(train, spec), train.sparkSession, spec.rank, path)
    if spec.ml_ratings is not None and spec.max_iter > 0 and not (path and model_exists(train.sparkSession, path)):
        from recsift.operators.read_als import fit_read_als, readable

        if train.count() > spec.ml_ratings and readable(checkpoint_dir(train.sparkSession)):
            return fit_or_load_factors(lambda: fit_read_als(train, spec), train.sparkSession, spec.rank, path)
    data = train.select("user_id", "item_id",
                        F.col(spec.rating_col).cast("float").alias(spec.rating_col))
    return fit_or_load_als(spec.estimator(), data, path)


REC_SCHEMA = "user_id int, pos int, item_id int, rating float"

# Factors (floats) in one block of users or items: what a task holds of each.
BLOCK_FLOATS = 4_000_000
# Floats of items sent to the blocks of users at most; of more, items are written and read.
SENT_FLOATS = 1 << 22
# Below that bound users still go to several blocks, so that a small scoring
# has some parallelism: up to so many blocks of at least so many users.
SMALL_BLOCKS, SMALL_BLOCK_USERS = 16, 256
# Item blocks whose lists one step of the reduction merges.
MERGE = 16


def n_blocks(rows: int, rank: int, floats: int = BLOCK_FLOATS) -> int:
    return max(1, -(-rows * max(rank, 1) // floats))


def _score(k: int):
    """Cogroup function: top-k items of one item block for the users of one user block."""
    import recsift.functions.topk as topk_mod
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(topk_mod)  # executors need not install the package
    top_k = topk_mod.top_k

    def run(users, items):
        import numpy as np
        import pyarrow as pa

        def out(user, pos, item, rating, ib):
            return pa.table({"user_id": pa.array(user, pa.int32()), "pos": pa.array(pos, pa.int32()),
                             "item_id": pa.array(item, pa.int32()), "rating": pa.array(rating, pa.float32()),
                             "ib": pa.array(ib, pa.int32())})

        if not len(users) or not len(items):
            return out([], [], [], [], [])

        def matrix(table):
            flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("features").chunks])
            return flat.astype(np.float32, copy=False).reshape(len(table), -1)

        scores, ids = top_k(matrix(users), matrix(items), items.column("id").to_numpy(), k)
        w = scores.shape[1]
        return out(np.repeat(users.column("id").to_numpy(), w).astype(np.int32),
                   np.tile(np.arange(1, w + 1, dtype=np.int32), len(users)), ids.ravel().astype(np.int32),
                   scores.ravel(), np.full(w * len(users), users.column("ib")[0].as_py(), dtype=np.int32))

    return run


def _norm():
    return F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _item_blocks(items: DataFrame, wanted: int) -> tuple[DataFrame, list[float]]:
    """``items`` (``id, features, norm``) with their block ``ib``, and each
    block's largest norm. Blocks are cut at quantiles of the norm, falling; one
    that equal norms make too large is cut on by hash. The driver holds a few
    numbers per block."""
    cuts = sorted(set(items.approxQuantile("norm", [1 - (i + 1) / wanted for i in range(wanted - 1)], 0.01)), reverse=True)
    stretch = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: F.col("norm") < c))
    items = items.withColumn("ib", stretch)
    held = {r["ib"]: r for r in items.groupBy("ib").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).collect()}
    size = -(-sum(r["n"] for r in held.values()) // wanted)
    first, parts, tops = [], [], []
    for b in range(len(cuts) + 1):
        first.append(len(tops))
        parts.append(max(1, -(-held[b]["n"] // (2 * size))) if b in held else 1)
        tops += [held[b]["top"] if b in held else 0.0] * parts[-1]
    of = lambda x: F.element_at(F.array(*map(F.lit, x)), F.col("ib") + 1)
    return items.withColumn("ib", (of(first) + F.pmod(F.xxhash64("id"), of(parts))).cast("int")), tops


def _lists(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    return left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInArrow(_score(k), REC_SCHEMA + ", ib int")


def recommend_long(model, users: DataFrame, k: int, block_floats: int | None = None) -> DataFrame:
    """Exact top-k items per user for a user subset, long: ``(user_id, pos, item_id, rating)``.

    Users unknown to the model are dropped (semi join before any scoring).
    Users are hashed into blocks of at most about ``block_floats`` factors,
    items are cut into such blocks by falling norm. A pair of blocks meets in
    one cogroup, where numpy scores bounded tiles and keeps the k best items of
    the block for each user.

    No score exceeds the product of two norms. So every user first meets the
    block of the largest norms, and then only those blocks whose largest norm
    could still give more than the user's k-th score; within a block, tiles are
    skipped alike. The lists of ``MERGE`` item blocks at a time are then merged
    until one is left, so no step sees more than ``k * MERGE`` rows per user.
    Where that would send more than ``SENT_FLOATS`` floats of items to the blocks of users,
    the items are written once and read by them (:mod:`recsift.operators.read_lists`).
    Factors stay on the executors: no collect, no broadcast, no cross join.
    Order: score descending, then item id ascending.
    """
    from recsift.operators.joins import materialize_keys

    rank = int(model.rank)
    floats = block_floats or BLOCK_FLOATS
    items = model.itemFactors.select("id", "features", _norm().alias("norm"))
    wanted = users.select(F.col("user_id").alias("id")).distinct()
    # written once: every step below reads them
    factors = materialize_keys(model.userFactors.join(wanted, "id", "left_semi").select("id", "features"))
    n_users, n_items = factors.count(), items.count()
    item_blocks = n_blocks(n_items, rank, floats)
    user_blocks = max(n_blocks(n_users, rank, floats),
                      min(SMALL_BLOCKS, -(-n_users // SMALL_BLOCK_USERS)))
    if n_items * rank * user_blocks > SENT_FLOATS:
        from recsift.operators.read_als import readable
        from recsift.operators.read_lists import read_lists
        from recsift.session import checkpoint_dir

        if readable(checkpoint_dir(users.sparkSession)):
            return read_lists(factors, model.itemFactors, rank, k, n_users, n_items, floats)
    left = factors.withColumn("ub", F.pmod(F.xxhash64("id"), F.lit(max(1, user_blocks))).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(max(0, user_blocks - 1))))
    if item_blocks == 1:
        zero = F.lit(0).alias("ib")
        return _lists(left.select("id", "features", "ub", zero), items.select("id", "features", every.alias("ub"), zero), k) \
            .select("user_id", "pos", "item_id", "rating")
    items, tops = _item_blocks(materialize_keys(items), item_blocks)  # cuts, counts and both scorings read the norms
    item_blocks = len(tops)
    long = materialize_keys(_lists(left.select("id", "features", "ub", F.lit(0).alias("ib")),
                                   items.filter("ib = 0").select("id", "features", every.alias("ub"), "ib"), k))
    kth = long.filter(F.col("pos") == k).select(F.col("user_id").alias("id"), F.col("rating").alias("kth"))
    # norms fall from block to block, so the blocks that a user needs come first; a little more for rounding
    reach = F.size(F.filter(F.array(*map(F.lit, tops[1:])), lambda top: F.col("kth").isNull() | (
        top * F.col("norm") * (1 + 1e-5) >= F.col("kth"))))
    left = left.withColumn("norm", _norm()).join(kth, "id", "left").withColumn("need", reach).filter("need > 0") \
        .select("id", "features", "ub", F.explode(F.sequence(F.lit(1), F.col("need"))).alias("ib"))
    left = materialize_keys(left)
    pairs = left.select(F.col("ub").alias("_u"), F.col("ib").alias("_b")).distinct()
    right = items.join(pairs, F.col("ib") == F.col("_b")).select("id", "features", F.col("_u").alias("ub"), "ib")
    long = long.unionByName(_lists(left, right, k))
    while item_blocks > 1:
        item_blocks = -(-item_blocks // MERGE)
        long = long.withColumn("ib", F.floor(F.col("ib") / MERGE).cast("int"))
        w = Window.partitionBy("user_id", "ib").orderBy(F.desc("rating"), F.asc("item_id"))
        long = long.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)
    return long.select("user_id", "pos", "item_id", "rating")


def recommend(model, users: DataFrame, k: int, block_floats: int | None = None) -> DataFrame:
    """Top-k lists per user, ``(user_id, recommendations array<struct<item_id, rating>>)``
    best first, the layout of ``ALSModel.recommendForUserSubset`` (see :func:`recommend_long`)."""
    return collect_recs(recommend_long(model, users, k, block_floats))


def explode_recs(recs: DataFrame) -> DataFrame:
    """Long form ``(user_id, pos, item_id, rating)``; ``pos`` keeps the rank."""
    return (recs.select("user_id", F.posexplode("recommendations").alias("pos0", "recs"))
            .select("user_id", (F.col("pos0") + 1).alias("pos"), "recs.*"))


def pred_labels(recs: DataFrame) -> DataFrame:
    """Predicted item ids in rank order: nested-field projection of the list,
    returned long as ``(user_id, pos, item_id)``."""
    return (recs.select("user_id", F.posexplode(F.col("recommendations.item_id"))
                        .alias("pos0", "item_id"))
            .select("user_id", (F.col("pos0") + 1).alias("pos"), "item_id"))


def collect_recs(long: DataFrame) -> DataFrame:
    """Long form back to a list per user. Lists are at most k long."""
    return long.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "item_id", "rating"))),
                    lambda s: F.struct(s["item_id"].alias("item_id"),
                                       s["rating"].cast("float").alias("rating")))
        .alias("recommendations"))


def popularity_long(train: DataFrame, users: DataFrame, k: int, by: str = "rating",
                    cohorts: int = 8) -> DataFrame:
    """Deterministic top-k rows ``(user_id, pos, item_id, rating)``: the k train
    items with the most rows (``by='rating'``) or most reviews
    (``by='review'``) among the users of the user's cohort, ties to the lower id.

    Used where a query must be checkable by an independent engine (ALS output
    is not). Cohorts are hash buckets of the user, so lists differ between
    users. The lists have ``k * cohorts`` rows whatever the data, which is
    what is broadcast.
    """
    score = F.count(F.lit(1)) if by == "rating" else F.sum("is_reviewed")
    cohort = bucket("cohort", "user_id", modulus=cohorts).alias("cohort")
    scored = train.select(cohort, "item_id", "is_reviewed").groupBy("cohort", "item_id") \
        .agg(score.cast("double").alias("score"))
    w = Window.partitionBy("cohort").orderBy(F.desc("score"), F.asc("item_id"))
    top = scored.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)
    return (users.select("user_id").distinct().withColumn("cohort", bucket("cohort", "user_id", modulus=cohorts))
            .join(F.broadcast(top), "cohort")
            .select("user_id", "pos", "item_id", F.col("score").cast("float").alias("rating")))


def popularity_recs(train: DataFrame, users: DataFrame, k: int, by: str = "rating",
                    cohorts: int = 8) -> DataFrame:
    """:func:`popularity_long` as lists per user."""
    return collect_recs(popularity_long(train, users, k, by, cohorts))
