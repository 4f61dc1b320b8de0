"""The solver that spreads hot ids: against Spark ML, skew, and pruned scoring."""

import os
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recsift.functions.topk import top_k
from recsift.operators import ALSSpec, fit_als, recommend_long, remove_zeros
from recsift.operators import gram_als
from recsift.operators import recs as recs_mod
from recsift.operators.gram_als import FactorModel, deal, fit_gram_als, initial_factors
from recsift.sources import interactions

SPEC = ALSSpec(rank=6, reg=0.05, max_iter=3, blocks=4)


def _factors(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


def _gap(a, b):
    a, b = _factors(a), _factors(b)
    assert a.keys() == b.keys()
    return max(np.abs(a[i] - b[i]).max() for i in a)


def _ml(train, spec):
    data = train.select("user_id", "item_id", F.col(spec.rating_col).cast("float").alias(spec.rating_col))
    return spec.estimator().fit(data)


def _hot(spark):
    """A user and an item with about a third of the ratings each."""
    rows = [(u, i, 1 + (u * 7 + i * 3) % 5, (u + i) % 3 % 2) for u in range(1, 121) for i in range(1, 61) if (u * 31 + i * 17) % 23 == 0]
    rows += [(999, i, 1 + i % 5, i % 2) for i in range(1, 400)] + [(u, 777, 1 + u % 5, u % 2) for u in range(1, 400)]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating int, is_reviewed int")


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize("table", ["plain", "hot"])
def test_factors_equal_spark_mls(spark, implicit, table):
    train = remove_zeros(interactions(spark, SF001)) if table == "plain" else _hot(spark)
    spec = replace(SPEC, implicit=implicit)
    start = _ml(train, replace(spec, max_iter=0)).userFactors
    own, ml = fit_gram_als(train, spec, start), _ml(train, spec)
    assert _gap(own.userFactors, ml.userFactors) < 1e-4
    assert _gap(own.itemFactors, ml.itemFactors) < 1e-4


def test_parts_of_a_hot_id_are_even_and_change_nothing(spark):
    train = _hot(spark).withColumn("rating", F.col("rating").cast("float"))
    side = deal(train.select("user_id", "item_id", "rating"), "user_id", "item_id", 8)
    sizes = sorted(len(r["rating"]) // 4 for r in side.packed.collect())
    assert side.n_hot >= 1 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    one = fit_gram_als(train, replace(SPEC, blocks=1))
    for parts in (8, 40):  # 40: the partial equations are added in two levels
        many = fit_gram_als(train, replace(SPEC, blocks=parts))
        assert _gap(one.userFactors, many.userFactors) < 1e-4


def test_lists_equal_spark_mls(spark):
    train = remove_zeros(interactions(spark, SF001))
    users = train.select("user_id").distinct()
    ml = _ml(train, SPEC)
    own = fit_gram_als(train, SPEC, _ml(train, replace(SPEC, max_iter=0)).userFactors)
    lists = [{(r.user_id, r.pos): r.rating for r in recommend_long(m, users, 10).collect()} for m in (ml, own)]
    assert lists[0].keys() == lists[1].keys()
    assert max(abs(lists[0][x] - lists[1][x]) for x in lists[0]) < 1e-4


def test_initial_factors_are_unit_vectors_of_the_id(spark):
    ids = spark.range(50).select(F.col("id").cast("int").alias("id"))
    a, b = _factors(initial_factors(ids, 8, 1)), _factors(initial_factors(ids.repartition(7), 8, 1))
    assert all(abs(np.linalg.norm(v) - 1) < 1e-5 and (v == b[i]).all() for i, v in a.items())
    assert len({tuple(v) for v in a.values()}) == 50


def test_nulls_and_empty_tables(spark):
    kind = "user_id int, item_id int, rating int, is_reviewed int"
    rows = [(1, 1, 4, 1), (None, 1, 5, 0), (2, None, 5, 0), (2, 1, None, 0), (2, 2, 3, 0)]
    model = fit_gram_als(spark.createDataFrame(rows, kind), SPEC)
    assert sorted(_factors(model.userFactors)) == [1, 2] and sorted(_factors(model.itemFactors)) == [1, 2]
    empty = fit_gram_als(spark.createDataFrame([], kind), replace(SPEC, implicit=True))
    assert empty.userFactors.count() == empty.itemFactors.count() == 0
    with pytest.raises(ValueError):
        ALSSpec(solver="other")


def test_saved_factors_are_read_back(spark, tmp_path):
    train = _hot(spark)
    spec = replace(SPEC, solver="gram")
    first = fit_als(train, spec, str(tmp_path / "m"))
    again = fit_als(train.limit(0), spec, str(tmp_path / "m"))
    assert again.rank == 6 and _gap(first.userFactors, again.userFactors) == 0


def _skewed(n_users, n_items, seed=0):
    rng = np.random.default_rng(seed)
    users = rng.normal(size=(n_users, 8)).astype(np.float32)
    items = (rng.normal(size=(n_items, 8)) * rng.pareto(1.5, size=(n_items, 1))).astype(np.float32)
    items[rng.integers(0, n_items, 200)] = items[3]  # ties
    return users, items


def _brute(users, items, ids, k):
    scores = users @ items.T
    return [[(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:k]] for s in scores]


def test_pruned_kernel_is_exact_and_scores_under_half():
    users, items = _skewed(300, 6000)
    ids, scored = np.random.default_rng(1).permutation(6000), []
    s, i = top_k(users, items, ids, 10, item_tile=256, scored=scored)
    brute = _brute(users, items, ids, 10)
    assert np.allclose(s, [[x for _, x in r] for r in brute], rtol=1e-5)
    assert np.mean([[a == b for a, (b, _) in zip(x, y, strict=True)] for x, y in zip(i.tolist(), brute, strict=True)]) > 0.99
    assert scored[0] < 300 * 6000 / 2


def test_blocks_of_small_norm_are_not_sent(spark, monkeypatch):
    users, items = _skewed(40, 3000, 2)
    table = lambda x: spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(x)], "id int, features array<float>")
    model = FactorModel(8, table(users), table(items))
    wanted = spark.range(40).select(F.col("id").cast("int").alias("user_id"))
    met = []
    lists = recs_mod._lists
    monkeypatch.setattr(recs_mod, "_lists", lambda left, right, k: met.append(
        left.groupBy("ub", "ib").count().join(right.groupBy("ub", "ib").agg(F.count("*").alias("m")), ["ub", "ib"])
        .agg(F.sum(F.col("count") * F.col("m"))).first()[0] or 0) or lists(left, right, k))
    got = recommend_long(model, wanted, 10, block_floats=8 * 150).collect()
    brute = _brute(users, items, np.arange(3000), 10)
    assert sum(met) < 40 * 3000 / 2
    assert {(r.user_id, r.pos) for r in got} == {(u, p) for u in range(40) for p in range(1, 11)}
    assert all(abs(r.rating - brute[r.user_id][r.pos - 1][1]) < 1e-3 for r in got)


def test_equal_norms_are_cut_by_hash(spark):
    items = spark.createDataFrame([(j, [1.0, 0.0]) for j in range(1000)], "id int, features array<float>")
    blocks, tops = recs_mod._item_blocks(items.withColumn("norm", recs_mod._norm()), 10)
    sizes = [r["count"] for r in blocks.groupBy("ib").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400 and len(tops) >= len(sizes)


def test_ids_of_few_ratings_are_solved_with_few_equations(monkeypatch):
    """5 and 3 ratings at rank 40: systems of 5 and 3 equations, the solution of the 40 by 40 one."""
    rng, rank, reg = np.random.default_rng(3), 40, 0.1
    vectors, src = rng.normal(size=(8, rank)).astype("<f4"), np.array([0, 1, 2, 3, 4, 5, 6, 7], dtype="<i4")
    dst, rating = np.array([1] * 5 + [2] * 3, dtype="<i4"), np.arange(1, 9).astype("<f4")
    packed = pa.table({"part": pa.array([0], pa.int32()), "dst": [dst.tobytes()], "src": [src.tobytes()],
                       "rating": [rating.tobytes()], "hot": [np.zeros(8, dtype="?").tobytes()]})
    factors = pa.table({"part": pa.array([0], pa.int32()), "ids": [src.tobytes()], "vectors": [vectors.tobytes()]})
    sizes, solve = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: sizes.append(a.shape[-1]) or solve(a, b))
    out = gram_als._half(rank, reg, False, 1.0, None)(packed, factors)
    got = dict(zip(out.column("id").to_pylist(), out.column("features").to_pylist(), strict=True))
    assert sorted(sizes) == [3, 5]
    for i in (1, 2):
        x, r = vectors[dst == i].astype(float), rating[dst == i]
        assert np.allclose(got[i], solve(x.T @ x + reg * len(r) * np.eye(rank), x.T @ r), atol=1e-5)


def test_start_vectors_take_no_time_by_the_square_of_the_rank(spark):
    ids = spark.range(10).select(F.col("id").cast("int").alias("id"))
    plan = initial_factors(ids, 500, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan  # the length is not added up once an element


def test_a_fit_of_a_rank_above_the_ratings_equals_spark_mls(spark):
    train = remove_zeros(interactions(spark, SF001))
    spec = replace(SPEC, rank=60)
    start = _ml(train, replace(spec, max_iter=0)).userFactors
    own, ml = fit_gram_als(train, spec, start), _ml(train, spec)
    assert _gap(own.userFactors, ml.userFactors) < 1e-4
    assert _gap(own.itemFactors, ml.itemFactors) < 1e-4


def _sent_per_id(spark, ratings, spec, monkeypatch, part_ratings):
    """Rows that the half-iterations send for each id, and whether one of them deals the ratings again."""
    sent, step = [], gram_als._step

    def seen(here, other, factors, spec):
        rows = factors.select("id", "features", "to").mapInArrow(gram_als._ship(spec.rank, here.keys), gram_als._SENT)
        sent.append(rows.agg(F.sum("n")).first()[0] / factors.count())
        return step(here, other, factors, spec)

    monkeypatch.setattr(gram_als, "_step", seen)
    model = fit_gram_als(ratings, spec, part_ratings=part_ratings)
    return sent, model


def test_more_parts_send_no_factor_more_often(spark, monkeypatch):
    """40 parts go in 2 groups: an id's factors are sent twice at most, and are those of one part."""
    train = remove_zeros(interactions(spark, SF001))
    spec = replace(SPEC, blocks=4)
    sent, many = _sent_per_id(spark, train, spec, monkeypatch, train.count() // 40)
    assert len(sent) == 2 * spec.max_iter and max(sent) <= 2
    one = fit_gram_als(train, replace(SPEC, blocks=1))
    assert _gap(one.userFactors, many.userFactors) < 1e-4 and _gap(one.itemFactors, many.itemFactors) < 1e-4


def test_ratings_stay_in_their_groups(spark, monkeypatch):
    """A half-iteration shuffles factors only: the cogroup's other side is read as cached."""
    plans, keep = [], gram_als.materialize_keys
    train = _hot(spark)
    monkeypatch.setattr(gram_als, "materialize_keys", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    fit_gram_als(train, replace(SPEC, max_iter=1))
    halves = [p.split("InMemoryRelation")[0] for p in plans if "FlatMapCoGroupsInArrow" in p and "InMemoryTableScan" in p]
    assert len(halves) == 2 and all(p.count("Exchange") == 1 for p in halves)


def test_sent_factors_lose_nothing():
    rng = np.random.default_rng(5)
    ids, x = np.sort(rng.choice(1 << 30, 500, replace=False)).astype("<i4"), rng.normal(size=(500, 7)).astype("<f4")
    x[0], x[1, 0] = np.nan, -0.0
    told = [gram_als._shrink(ids[s], x[s]) for s in (slice(0, 1), slice(1, 500))]
    sent = pa.table({"n": pa.array([1, 499], pa.int32()), **{c: list(v) for c, v in zip(("ids", "vectors", "high"), zip(*told))}})
    got = gram_als._grow(sent, 7)
    assert got.column("ids")[0].as_py() == ids.tobytes() and got.column("vectors")[0].as_py() == x.tobytes()
    assert sum(map(len, told[1])) < 0.9 * 499 * (4 + 28)


def test_groups_grow_only_by_what_one_may_hold():
    side = gram_als.Side(None, 300, 0)
    spec = replace(SPEC, rank=10, blocks=16)
    assert gram_als.n_groups(side, 10_000, 5_000_000, spec) == 8
    for ids, ratings in ((7_200_000, 140_000_000), (50_000_000, 140_000_000)):
        n = gram_als.n_groups(side, ids, ratings, spec)
        assert ratings / n <= gram_als.GROUP_RATINGS
        assert ids * (1 - np.exp(-ratings / n / ids)) * spec.rank <= gram_als.PART_FLOATS


def test_ratings_of_a_fit_take_little_room(spark):
    """12 bytes a rating before compression; a checkpoint's rows took over 40."""
    train = remove_zeros(interactions(spark, SF001))
    files = gram_als.rated(train, SPEC).inputFiles()
    assert sum(os.path.getsize(f.removeprefix("file://")) for f in files) < 12 * train.count() + 4096 * len(files)
