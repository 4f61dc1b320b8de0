"""A hot user and a hot item each holding about a third of the rows.

The split must give the same rows whichever join strategy the size checks
pick (broadcast key tables, or shuffle joins once the bound is exceeded), and
keep its invariants.
"""

import pytest
from pyspark.sql import functions as F

from recsift.plans import PrepareSpec, prepare, prepare_stepwise

HOT_USER, HOT_ITEM = 1, 1


@pytest.fixture(scope="module")
def skewed(spark):
    # users 2..301 rate a sliding window of 20 items plus the hot item;
    # the hot user rates items 1..3300
    others = (spark.range(2, 302).withColumnRenamed("id", "u")
              .select("u", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("j"))
              .select(F.col("u").cast("int").alias("user_id"),
                      F.when(F.col("j") == 0, F.lit(HOT_ITEM))
                      .otherwise(2 + (F.col("u") * 7 + F.col("j")) % 3299).cast("int").alias("item_id")))
    hot = spark.range(1, 3301).select(F.lit(HOT_USER).alias("user_id"),
                                      F.col("id").cast("int").alias("item_id"))
    rows = others.unionByName(hot).dropDuplicates(["user_id", "item_id"])
    return rows.select(
        "user_id", "item_id",
        ((F.col("user_id") * 5 + F.col("item_id") * 3) % 6).cast("int").alias("rating"),
        ((F.col("user_id") + F.col("item_id")) % 4 == 0).cast("int").alias("is_reviewed"),
    ).persist()


def test_fixture_is_skewed(skewed):
    n = skewed.count()
    assert skewed.filter(F.col("user_id") == HOT_USER).count() > n / 3
    assert skewed.filter(F.col("item_id") == HOT_ITEM).count() >= 300


@pytest.mark.parametrize("max_rows", [None, "0"])
def test_skewed_prepare_same_under_both_join_strategies(spark, skewed, max_rows):
    key = "recsift.broadcast.maxRows"
    auto = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if max_rows is not None:           # no hint and no automatic broadcast: shuffle joins
        spark.conf.set(key, max_rows)
        for a in auto:
            spark.conf.set(a, "-1")
    try:
        spec = PrepareSpec(fraction=1.0, low_threshold=10, seed=5)
        fused = prepare(skewed, spec)
        if max_rows is not None:
            from test_plans import formatted

            plan = formatted(fused)
            assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        a = fused.persist()
        b = prepare_stepwise(skewed, spec)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        rows = a.collect()
        train_users = {r.user_id for r in rows if r.split == "train"}
        train_items = {r.item_id for r in rows if r.split == "train"}
        held = [r for r in rows if r.split != "train"]
        assert held and {r.user_id for r in held} <= train_users
        assert {r.item_id for r in held} <= train_items
        # the hot user is far above the threshold: it stays, losing at most
        # held-out rows of items only it has rated
        hot_rated = skewed.filter((F.col("user_id") == HOT_USER) & (F.col("rating") > 0)).count()
        assert 0 < sum(1 for r in rows if r.user_id == HOT_USER) <= hot_rated
        a.unpersist()
    finally:
        for k in (key, *auto):
            spark.conf.unset(k)
