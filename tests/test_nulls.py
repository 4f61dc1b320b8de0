"""Null ids: dropped at the source, and alike on every branch of keep_keys."""

import tempfile

import pytest

from recsift.operators import remove_low_users
from recsift.operators.joins import keep_keys
from recsift.sources import interactions

SCHEMA = "user_id int, item_id int, rating int"


@pytest.mark.parametrize("dropped", [0, 1, 3])  # keep all; anti join; semi join
def test_keep_keys_drops_null_keys_on_every_branch(spark, dropped):
    df = spark.createDataFrame([(u, 1, 1) for u in range(4)] + [(None, 1, 1)] * 3, SCHEMA)
    decisions = spark.createDataFrame([(u, u >= dropped) for u in range(4)], "user_id int, keep boolean")
    kept = keep_keys(df, decisions, "user_id")
    assert sorted(r.user_id for r in kept.collect()) == list(range(dropped, 4))


@pytest.mark.parametrize("light", [0, 4])
def test_low_user_removal_drops_null_users_whatever_the_others(spark, light):
    rows = [(1, i, 5) for i in range(5)] + [(None, i, 5) for i in range(3)] + [(10 + u, 1, 5) for u in range(light)]
    kept = remove_low_users(spark.createDataFrame(rows, SCHEMA), 2)
    assert {r.user_id for r in kept.collect()} == {1}


def test_source_drops_rows_without_ids(spark):
    path = tempfile.mkdtemp(prefix="recsift-null-", dir="/tmp") + "/i.csv"
    spark.createDataFrame([("1", "2", "1", "5", "0"), ("x", "2", "1", "5", "0"), ("1", "", "1", "5", "0")],
                          "user_id string, item_id string, is_read string, rating string, is_reviewed string") \
        .write.option("header", True).csv(path)
    assert [tuple(r) for r in interactions(spark, path).collect()] == [(1, 2, 1, 5, 0)]
