from pyspark.sql import functions as F

from recsift.operators import fuse_scores, topk_lists, topk_lists_running
from recsift.operators.hybrid import weigh

SCORES = [(1, 1, 5.0), (1, 2, 4.0), (1, 3, 4.0), (1, 4, 3.0),
          (2, 1, 5.0), (2, 2, 4.0), (2, 3, 4.0), (3, 1, 9.0)]


def _scores(spark):
    return spark.createDataFrame(SCORES, "user_id int, item_id int, rating double")


def test_topk_total_order_keeps_short_lists(spark):
    got = topk_lists(_scores(spark), 2).orderBy("user_id", "pos").collect()
    assert [(r.user_id, r.item_id) for r in got] == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]


def test_running_list_literal_ties(spark):
    assert topk_lists_running(_scores(spark), 2).count() == 0
    got = sorted(tuple(r) for r in topk_lists_running(_scores(spark), 3).collect())
    assert got == [(1, "1,2,3"), (1, "1,2,3"), (2, "1,2,3"), (2, "1,2,3")]


def test_fuse_full_outer_zero_fill(spark):
    rat = spark.createDataFrame([(1, 1, 3.0), (1, 2, 2.0)], "user_id int, item_id int, rating double")
    rev = spark.createDataFrame([(1, 2, 1.0), (1, 3, 0.5), (2, 9, 1.0)],
                                "user_id int, item_id int, rating double")
    got = {(r.user_id, r.item_id): (r.rat_rating, r.rev_rating, r.rating)
           for r in fuse_scores(rat, rev, 2.0).collect()}
    assert got == {(1, 1): (3.0, 0.0, 3.0), (1, 2): (2.0, 1.0, 4.0), (1, 3): (0.0, 0.5, 1.0),
                   (2, 9): (0.0, 1.0, 2.0)}


def test_weigh_matches_single_weight(spark):
    rat = _scores(spark)
    rev = _scores(spark).withColumn("rating", F.col("item_id").cast("double"))
    fused = fuse_scores(rat, rev)
    multi = topk_lists(weigh(fused, [-1.0, 0.5]), 2, by=("weight",))
    for w in (-1.0, 0.5):
        one = topk_lists(fuse_scores(rat, rev, w), 2)
        a = sorted(tuple(r) for r in multi.filter(F.col("weight") == w).drop("weight").collect())
        b = sorted(tuple(r) for r in one.collect())
        assert a == b


def test_running_list_equals_literal_window(spark):
    """The O(k) form gives the rows of the literal running collect_list."""
    from pyspark.sql import Window

    rows = [(u, i, float((u * 7 + i * 3) % 4)) for u in range(1, 40) for i in range(1, 2 + u % 9)]
    scores = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"))
    literal = (scores.withColumn("items", F.collect_list("item_id").over(w)))
    for k in (1, 2, 3, 5, 8):
        want = (literal.filter(F.size("items") == k)
                .select("user_id", F.array_join(F.array_sort("items"), ",").alias("items")))
        got = topk_lists_running(scores, k)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
