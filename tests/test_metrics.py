import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recsift.operators import (
    eval_users,
    per_user_metrics,
    popularity_recs,
    pred_labels,
    ranking_metrics,
    split,
    split_view,
    true_labels,
)
from recsift.operators.filters import remove_low_users, remove_zeros
from recsift.sources import interactions


def _lists(spark, preds, truth):
    p = spark.createDataFrame([(u, i + 1, it) for u, items in preds.items()
                               for i, it in enumerate(items)], "user_id int, pos int, item_id int")
    t = spark.createDataFrame([(u, it) for u, items in truth.items() for it in items],
                              "user_id int, item_id int")
    return p, t


def test_metric_fixture(spark):
    p, t = _lists(spark, {1: [1, 2, 3, 4], 2: [5, 6], 3: [1]}, {1: [2, 9], 2: [5, 6, 7], 3: [2]})
    r = ranking_metrics(p, t, 3).first()
    assert r.map == pytest.approx(0.3055555555555555, abs=1e-9)
    assert r.ndcg_at_k == pytest.approx(0.38407114807438775, abs=1e-9)
    assert r.precision_at_k == pytest.approx(0.3333333333333333, abs=1e-9)
    assert r.n_users_evaluated == 3 and r.n_users_with_labels == 3


def test_users_without_list_or_labels_are_not_evaluated(spark):
    p, t = _lists(spark, {1: [1, 2], 4: [1]}, {1: [2], 5: [3]})
    rows = per_user_metrics(p, t, 2).collect()
    assert [r.user_id for r in rows] == [1]
    assert rows[0].ap == pytest.approx(0.5)


def test_parity_with_mllib_ranking_metrics(spark):
    from pyspark.mllib.evaluation import RankingMetrics

    inter = interactions(spark, SF001)
    s = split(remove_low_users(remove_zeros(inter), 2))
    train = split_view(s, "train", ("user_id", "item_id", "rating", "is_reviewed"))
    val = split_view(s, "val")
    k = 20
    recs = popularity_recs(train, eval_users(val), k)
    preds = pred_labels(recs)
    labels = true_labels(val)
    ours = ranking_metrics(preds, labels, k).first()
    lists = preds.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "item_id"))),
                    lambda x: x["item_id"]).alias("p"))
    lab = labels.groupBy("user_id").agg(F.collect_list("item_id").alias("t"))
    pairs = lists.join(lab, "user_id").select("p", "t").rdd.map(lambda r: (r[0], r[1]))
    m = RankingMetrics(pairs)
    assert ours.map == pytest.approx(m.meanAveragePrecision, abs=1e-9)
    assert ours.ndcg_at_k == pytest.approx(m.ndcgAt(k), abs=1e-9)
    assert ours.precision_at_k == pytest.approx(m.precisionAt(k), abs=1e-9)
    assert ours.n_users_evaluated == pairs.count()


def test_short_lists_divide_by_k(spark):
    p, t = _lists(spark, {1: [7]}, {1: [7]})
    r = per_user_metrics(p, t, 5).first()
    assert r.precision == pytest.approx(1 / 5)
    assert r.ndcg == pytest.approx(1.0)
    assert r.ap == pytest.approx(1.0)
    assert not math.isnan(r.ndcg)
