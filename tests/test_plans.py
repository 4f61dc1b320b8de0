"""Plan shapes: what reaches the scan, where shuffles happen, what is broadcast."""

import re
import tempfile

import pytest

from conftest import SF001
from recsift.operators import assign_roles, popularity_recs, remove_low_users, remove_zeros, tag_holdout
from recsift.operators.sampling import downsample_users
from recsift.sources import interactions, interactions_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _table(spark):
    root = tempfile.mkdtemp(prefix="recsift-plan-", dir="/tmp")
    return interactions_table(spark, SF001, root=root)


def test_zero_filter_reaches_scan_and_columns_pruned(spark):
    t = _table(spark)
    text = formatted(remove_zeros(t).select("user_id", "rating"))
    assert "PushedFilters: [IsNotNull(rating), GreaterThan(rating,0)]" in text
    assert "ReadSchema: struct<user_id:int,rating:int>" in text


def test_interaction_build_reads_only_needed_columns(spark):
    text = formatted(interactions(spark, SF001))
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,"
            "l_returnflag:string,l_linestatus:string>") in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_hash_sampling_and_tagging_do_not_shuffle(spark):
    t = _table(spark)
    df = tag_holdout(assign_roles(downsample_users(remove_zeros(t), 0.5)))
    text = formatted(df)
    assert "Exchange" not in text
    assert "WholeStageCodegen" in text or "*(" in text or "[codegen id" in text


def test_low_user_filter_broadcasts_bounded_side(spark):
    t = _table(spark)
    text = formatted(remove_low_users(remove_zeros(t), 28))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
    # the key table is read back from its checkpoint (lineage cut), not cached or recomputed
    assert "Scan ExistingRDD" in text and "InMemoryRelation" not in text


def test_low_user_filter_shuffle_join_beyond_bound(spark):
    spark.conf.set("recsift.broadcast.maxRows", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        t = _table(spark)
        df = remove_low_users(remove_zeros(t), 28)
        text = formatted(df)
        assert "BroadcastHashJoin" not in text
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        assert df.count() > 0
    finally:
        spark.conf.unset("recsift.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_popularity_lists_are_a_bounded_broadcast(spark):
    t = remove_zeros(_table(spark)).select("user_id", "item_id", "is_reviewed")
    text = formatted(popularity_recs(t, t.select("user_id"), 5))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "WindowGroupLimit" in text  # k rows per cohort leave each task


@pytest.mark.parametrize("name", ["map_metric", "ranking_metrics", "fuse_scores", "topk_lists_running",
                                  "tune_weight_lists", "split_report", "als_topk_explicit_rows"])
def test_a_query_builds_its_split_once_and_reads_only_written_tables(spark, monkeypatch, name):
    import __spark_entry__ as E
    from conftest import SF001

    built = []
    table, write = E.interactions_table, E.materialize
    monkeypatch.setattr(E, "interactions_table", lambda *a, **k: built.append("rows") or table(*a, **k))
    monkeypatch.setattr(E, "materialize", lambda *a, **k: built.append("split") or write(*a, **k))
    plan = formatted(E.queries()[name](spark, SF001))
    assert built == ["rows", "split"]
    assert "lineitem" not in plan and "orders" not in plan


def _long(spark, rows):
    return spark.createDataFrame(rows, "user_id int, pos int, item_id int, rating double")


def test_fusion_is_one_aggregate_without_join(spark):
    from recsift.operators import fuse_scores, topk_lists, topk_lists_running, weigh

    rat = _long(spark, [(1, 1, 1, 3.0), (1, 2, 2, 2.0)])
    rev = _long(spark, [(1, 1, 2, 1.0), (2, 1, 9, 1.0)])
    fused = fuse_scores(rat, rev, 0.5)
    assert "Join" not in formatted(fused)
    lists = formatted(topk_lists(weigh(fuse_scores(rat, rev), [0.0, 1.0]), 2, by=("weight",)))
    assert "Join" not in lists and "Generate" in lists          # weights exploded, not joined
    nodes = re.split(r"\n\(\d+\) ", formatted(topk_lists_running(fused, 2)))
    windows = [n for n in nodes if n.startswith("Window")]
    assert windows and not any("collect_list" in n for n in windows)   # running count only
