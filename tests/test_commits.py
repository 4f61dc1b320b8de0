"""Artefacts written by several drivers at once, and deltas merged into a split."""

import os
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001, SF01
from recsift.functions.hashing import bucket
from recsift.operators import ALSSpec, SplitSpec
from recsift.plans import PrepareSpec, get_model, merge_delta, prepare, read_split
from recsift.plans.merge import _head
from recsift.plans.prepare import user_action
from recsift.sources import commits, interactions, latest
from recsift.sources.commits import load_or_compute


def _side_by_side(*calls):
    """The calls' results, each from a thread of its own."""
    out, threads = {}, []
    for n, call in enumerate(calls):
        threads.append(threading.Thread(target=lambda n=n, call=call: out.__setitem__(n, call())))
        threads[-1].start()
    for t in threads:
        t.join()
    return [out[n] for n in range(len(calls))]


def _attempts(path):
    return sorted(f for f in os.listdir(path) if f.startswith("attempt-"))


def _lose_a_part(folder):
    parts = sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-"))
    os.remove(parts[0])


def test_of_two_writers_one_stands_and_both_read_it(spark, tmp_path):
    path, both = str(tmp_path / "t"), threading.Barrier(2)

    def writer(n):
        def compute():
            both.wait(60)  # neither has committed when both compute
            return spark.range(50).select(F.lit(n).alias("writer"), "id")
        return lambda: sorted(map(tuple, load_or_compute(spark, path, compute, sort_by=()).collect()))

    a, b = _side_by_side(writer(1), writer(2))
    assert a == b and len(a) == 50 and len({w for w, _ in a}) == 1
    assert len(commits(spark, path)) == 1 and _attempts(path) == [latest(spark, path).attempt]
    never = load_or_compute(spark, path, lambda: pytest.fail("computed again"))
    assert never.count() == 50


def test_unfinished_attempts_and_damaged_commits_do_not_exist(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(7).write.parquet(f"{path}/attempt-lost")  # a driver was lost before its commit
    assert latest(spark, path) is None
    table = lambda n: load_or_compute(spark, path, lambda: spark.range(n).repartition(3), sort_by=())
    assert table(30).count() == 30 and table(99).count() == 30
    first = latest(spark, path)
    _lose_a_part(first.folder)
    assert latest(spark, path) is None
    assert table(40).count() == 40 and [c.number for c in commits(spark, path)] == [0, 1]


@pytest.mark.parametrize("solver", ["ml", "gram"])
def test_models_fitted_at_once_and_lost_factors(spark, tmp_path, solver):
    df = spark.createDataFrame([(u, i, (u * i) % 5 + 1, 0) for u in range(20) for i in range(8)],
                               "user_id int, item_id int, rating int, is_reviewed int")
    path, spec = str(tmp_path / "m"), ALSSpec(rank=3, max_iter=1, blocks=2, solver=solver)
    factors = lambda: sorted((r.id, tuple(r.features)) for r in
                             get_model(df, spec, path).itemFactors.collect())
    a, b = _side_by_side(factors, factors)
    assert a == b == factors() and len(a) == 8 and len(commits(spark, path)) == 1
    _lose_a_part(f"{latest(spark, path).folder}/itemFactors")
    assert len(factors()) == 8 and len(commits(spark, path)) == 2


SPEC = PrepareSpec(seed=E.SEED, low_threshold=E.LOW, shares=E.SPARSE)


def _tenths(df, delta):
    """The rows of the tenth of pairs that come as a delta, or all others."""
    tenth = bucket("delta", "user_id", "item_id", modulus=10)
    return df.filter(tenth == 0) if delta else df.filter(tenth > 0)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _actions(spark, head):
    return {r.user_id: r.action for r in spark.read.parquet(f"{head.folder}/users")
            .select("user_id", user_action(SPEC).alias("action")).collect()}


def test_a_merged_delta_equals_a_full_rebuild(spark, tmp_path):
    inter = interactions(spark, SF01).cache()
    path = str(tmp_path / "s")
    merge_delta(_tenths(inter, False), path, SPEC, "base")
    assert _rows(read_split(spark, path)) == _rows(prepare(_tenths(inter, False), SPEC))
    old = _head(spark, path)
    before, items = _actions(spark, old), spark.read.parquet(f"{old.folder}/items")
    merge_delta(_tenths(inter, True), path, SPEC, "delta")
    assert _rows(read_split(spark, path)) == _rows(prepare(inter, SPEC))
    new = _head(spark, path)
    turned = {(before.get(u, "absent"), a) for u, a in _actions(spark, new).items()}
    assert {("drop", None), ("drop", "put_back"), ("put_back", None), ("put_back", "put_back")} <= turned
    flips = spark.read.parquet(f"{new.folder}/items").join(items.withColumnRenamed("n_train", "old"), "item_id") \
        .groupBy(((F.col("old") > 0).cast("int") - (F.col("n_train") > 0).cast("int")).alias("f")).count()
    assert {r.f for r in flips.collect()} > {0}
    inter.unpersist()


def test_only_the_buckets_of_new_rows_are_written(spark, tmp_path):
    inter, path = interactions(spark, SF01), str(tmp_path / "s")
    merge_delta(inter.filter("user_id > 3"), path, SPEC, "base")
    base = _head(spark, path)
    merge_delta(inter.filter("user_id <= 3"), path, SPEC, "few")
    head = _head(spark, path)
    rewritten = [b for b, a in head.notes["buckets"].items() if a == head.attempt]
    assert 1 <= len(rewritten) <= 4 and len(head.notes["buckets"]) > 30
    assert all(head.notes["buckets"][b] == a for b, a in base.notes["buckets"].items() if b not in rewritten)
    again = merge_delta(inter.filter("user_id <= 3"), path, SPEC, "few")
    assert again == head and _rows(read_split(spark, path)) == _rows(prepare(inter, SPEC))


def test_two_merges_at_once_both_count(spark, tmp_path):
    rows = [(u, i, (u + i) % 5 + 1, 0) for u in range(40) for i in range(u % 17)] + [(None, 1, 3, 0), (5, None, 3, 0)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating int, is_reviewed int")
    spec, path = PrepareSpec(seed=3, low_threshold=4, shares=SplitSpec(seed=3, train_share=100)), str(tmp_path / "s")
    merge_delta(df.limit(0), path, spec, "empty", buckets=4)
    assert read_split(spark, path).collect() == []
    parts = [df.filter(F.coalesce(F.col("item_id"), F.lit(0)) % 2 == p) for p in (0, 1)]
    _side_by_side(*[lambda p=p: merge_delta(parts[p], path, spec, f"part{p}", buckets=4) for p in (0, 1)])
    merge_delta(df.limit(0), path, spec, "nothing", buckets=4)
    assert [c.number for c in commits(spark, path)] == [0, 1, 2, 3]
    assert _rows(read_split(spark, path)) == _rows(prepare(df, spec))
    with pytest.raises(ValueError):
        merge_delta(df, path, spec, "other", buckets=8)
    with pytest.raises(FileNotFoundError):
        read_split(spark, str(tmp_path / "none"))
    gone = _head(spark, path).notes["buckets"].popitem()[1]
    _lose_a_part(f"{path}/{gone}/rows")
    with pytest.raises(RuntimeError):
        read_split(spark, path)


def test_a_delta_is_read_once_and_not_again_under_its_id(spark, tmp_path):
    """Its rows go through the caller's plan once; a retry does not run that plan."""
    read, path = spark.sparkContext.accumulator(0), str(tmp_path / "split")

    def seen(item):
        read.add(1)
        return item

    inter = _tenths(interactions(spark, SF001), False).filter("rating > 0")
    inter = spark.createDataFrame(inter.collect(), inter.schema)
    merge_delta(inter.withColumn("item_id", F.udf(seen, "int")("item_id")), path, SPEC, "base")
    assert read.value == inter.count()
    broken = inter.withColumn("item_id", F.raise_error(F.lit("read")).cast("int"))
    assert merge_delta(broken, path, SPEC, "base").number == 0
