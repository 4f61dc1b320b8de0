import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF001
import recsift.operators.recs as recs_module
from recsift.operators import ALSSpec, explode_recs, fit_als, recommend
from recsift.plans import PrepareSpec, prepare
from recsift.sources import interactions


@pytest.fixture(scope="module")
def splits(spark):
    return prepare(interactions(spark, SF001), PrepareSpec(low_threshold=2)).persist()


def _train(splits):
    return splits.filter(F.col("split") == "train")


def test_shape_and_known_user_rule(spark, splits):
    train = _train(splits)
    model = fit_als(train, ALSSpec(rank=5, max_iter=5))
    known = [r.user_id for r in train.select("user_id").distinct().limit(3).collect()]
    users = spark.createDataFrame([(u,) for u in known] + [(-1,)], "user_id int")
    recs = recommend(model, users, 4)
    got = {r.user_id: len(r.recommendations) for r in recs.collect()}
    assert set(got) == set(known)                     # unknown user dropped
    assert set(got.values()) == {4}
    long = explode_recs(recs)
    assert long.columns == ["user_id", "pos", "item_id", "rating"]
    ranked = long.filter(F.col("user_id") == known[0]).orderBy("pos").collect()
    assert [r.pos for r in ranked] == [1, 2, 3, 4]
    assert all(a.rating >= b.rating for a, b in zip(ranked, ranked[1:]))


def test_seed_stability(spark, splits):
    train = _train(splits)
    users = train.select("user_id").distinct()
    a = explode_recs(recommend(fit_als(train, ALSSpec(rank=4, max_iter=4)), users, 3))
    b = explode_recs(recommend(fit_als(train.repartition(3), ALSSpec(rank=4, max_iter=4)), users, 3))
    key = lambda df: sorted((r.user_id, r.pos, r.item_id) for r in df.collect())
    assert key(a) == key(b)


def test_implicit_model_on_review_flags(spark, splits):
    train = _train(splits)
    model = fit_als(train, ALSSpec(rank=4, max_iter=3, implicit=True))
    explicit = fit_als(train, ALSSpec(rank=4, max_iter=3))
    assert model.userFactors.count() == explicit.userFactors.count()
    assert model.itemFactors.count() == explicit.itemFactors.count()


def test_top_k_kernel_matches_full_sort_with_ties():
    import numpy as np

    from recsift.functions.topk import top_k

    rng = np.random.default_rng(3)
    users = rng.integers(-2, 3, size=(37, 3)).astype(np.float32)   # small ints: many ties
    items = rng.integers(-2, 3, size=(50, 3)).astype(np.float32)
    ids = rng.permutation(1000)[:50].astype(np.int64)
    for k in (1, 4, 7, 50, 60):
        s, i = top_k(users, items, ids, k, user_tile=8, item_tile=9)
        full = users @ items.T
        for r in range(users.shape[0]):
            order = sorted(range(50), key=lambda j: (-full[r, j], ids[j]))[:k]
            assert list(i[r]) == [ids[j] for j in order]
            assert np.allclose(s[r], full[r, order])


def _check_against_spark_ml(model, users, k, block_floats):
    """Same users, scores and - up to ties at equal score - items as Spark ML's
    own ``recommendForUserSubset`` (a blocked cartesian product)."""
    ref = {r.user_id: r.recommendations
           for r in model.recommendForUserSubset(users.select("user_id").distinct(), k).collect()}
    got = {r.user_id: r.recommendations for r in recommend(model, users, k, block_floats).collect()}
    assert set(got) == set(ref)
    for u, recs in ref.items():
        assert [x.rating for x in got[u]] == pytest.approx([x.rating for x in recs], abs=1e-4)
        lowest = recs[-1].rating + 1e-4
        sure = {x.item_id for x in recs if x.rating > lowest}
        assert sure <= {x.item_id for x in got[u]}
        for x, y in zip(got[u], recs):
            assert x.item_id == y.item_id or any(
                abs(y.rating - z.rating) < 1e-4 and z.item_id != y.item_id for z in (*recs, *got[u]))


@pytest.mark.parametrize("block_floats", [None, 5 * 40])  # one item block, then many
def test_recommend_matches_spark_ml(spark, splits, block_floats):
    model = fit_als(_train(splits), ALSSpec(rank=5, max_iter=5))
    users = splits.filter(F.col("split") == "val").select("user_id").distinct()
    _check_against_spark_ml(model, users, 6, block_floats)


def test_recommend_with_item_ids_that_are_multiples_of_the_block_count(spark, splits):
    train = _train(splits).withColumn("item_id", (F.col("item_id") * 8).cast("int"))
    model = fit_als(train, ALSSpec(rank=5, max_iter=3))
    users = splits.filter(F.col("split") == "val").select("user_id").distinct()
    n_items = model.itemFactors.count()
    _check_against_spark_ml(model, users, 6, 5 * -(-n_items // 8))


def test_recommend_plan_stays_on_the_executors(spark, splits):
    from test_plans import formatted

    train = _train(splits)
    model = fit_als(train, ALSSpec(rank=3, max_iter=2))
    plan = formatted(recommend(model, train.select("user_id"), 3))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "FlatMapCoGroupsInPandas" in plan
    source = open(recs_module.__file__).read()
    assert "toArrow" not in source and ".broadcast(_" not in source and "sc.broadcast" not in source


_FIT = """
import sys
sys.path.insert(0, sys.argv[2])
from recsift.operators import ALSSpec, fit_als, recommend_long
from recsift.session import local_session
spark = local_session(int(sys.argv[1]), shuffle_partitions=4, driver_memory="1g")
rows = [(u, i, (u * 7 + i * 3) % 5 + 1, 1) for u in range(40) for i in range(u % 5, 30, 3)]
df = spark.createDataFrame(rows, "user_id int, item_id int, rating int, is_reviewed int")
lists = recommend_long(fit_als(df, ALSSpec(rank=4, max_iter=4)), df.select("user_id"), 5)
print("LISTS", sorted((r.user_id, r.pos, r.item_id) for r in lists.collect()))
"""


def test_the_model_does_not_depend_on_the_number_of_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = [subprocess.run([sys.executable, "-c", _FIT, cores, root], capture_output=True, text=True, check=True,
                          timeout=300).stdout.partition("LISTS")[2] for cores in ("2", "4")]
    assert out[0] and out[0] == out[1]


def test_top_k_kernel_edges():
    import numpy as np

    from recsift.functions.topk import top_k

    users = np.ones((3, 2), dtype=np.float32)
    s, i = top_k(users, np.empty((0, 2), dtype=np.float32), np.empty(0, dtype=np.int64), 5)
    assert s.shape == (3, 0) and i.shape == (3, 0)
    items = np.array([[1, 0], [0, 2], [1, 1]], dtype=np.float32)
    s, i = top_k(users, items, np.array([30, 10, 20]), 5, item_tile=2)
    assert i.tolist() == [[10, 20, 30]] * 3 and s.tolist() == [[2.0, 2.0, 1.0]] * 3


def test_scoring_passes_blocks_as_arrow(spark):
    """A block of factors is one flat array in a task, not an object per id."""
    from recsift.operators import recs as recs_mod

    blocks = spark.createDataFrame([(1, [1.0, 0.0], 0, 0), (2, [0.0, 1.0], 0, 0)],
                                   "id int, features array<float>, ub int, ib int")
    lists = recs_mod._lists(blocks, blocks, 1)
    assert "FlatMapCoGroupsInArrow" in lists._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.user_id, r.item_id, r.rating) for r in lists.collect()) == [(1, 1, 1.0), (2, 2, 1.0)]


def test_scoring_reads_users_and_norms_from_one_written_table(spark, splits):
    """Wanted users are joined, and item norms computed, once however many steps read them."""
    from test_plans import formatted

    from recsift.operators import recommend_long

    model = fit_als(_train(splits), ALSSpec(rank=5, max_iter=2))
    users = splits.filter(F.col("split") == "val").select("user_id")
    few, many = (formatted(recommend_long(model, users, 6, floats)) for floats in (None, 5 * 40))
    assert "LeftSemi" not in few and "LeftSemi" not in many
    assert "aggregate(" not in many


@pytest.mark.parametrize("block_floats", [None, 5 * 40])  # one slice of users, then many
def test_lists_of_items_that_are_read_match_spark_ml(spark, splits, monkeypatch, block_floats):
    """Items are written once and not sent to each block of users."""
    from recsift.operators import read_lists
    from test_plans import formatted

    monkeypatch.setattr(recs_module, "SENT_FLOATS", 0)
    monkeypatch.setattr(recs_module, "_lists", None)
    monkeypatch.setattr(read_lists, "BLOCK_FLOATS", 5 * 7)  # several files and blocks
    model = fit_als(_train(splits), ALSSpec(rank=5, max_iter=5))
    users = splits.filter(F.col("split") == "val").select("user_id").distinct()
    _check_against_spark_ml(model, users, 6, block_floats)
    plan = formatted(recs_module.recommend_long(model, users, 6, block_floats))
    assert plan.count("Exchange") <= 2 and "Join" not in plan and "Window" not in plan
    all_items = model.itemFactors.count()
    assert recs_module.recommend_long(model, users, all_items + 5).groupBy("user_id").count().filter(F.col("count") != all_items).count() == 0


def test_blocks_of_items_that_nobody_needs_are_not_read():
    import numpy as np

    from recsift.functions.topk import top_k, top_k_of_blocks

    rng = np.random.default_rng(4)
    users = rng.normal(size=(3000, 6)).astype(np.float32)
    items = (rng.normal(size=(9000, 6)) * rng.pareto(1.5, size=(9000, 1))).astype(np.float32)
    items[rng.integers(0, 9000, 300)] = items[3]  # ties
    norms = np.linalg.norm(items, axis=1)
    order, ids, read, scored = np.argsort(-norms), rng.permutation(9000), [], []

    def blocks(at):
        for lo in range(0, len(at), 100):
            read.append(len(at[lo:lo + 100]))
            yield ids[at[lo:lo + 100]], items[at[lo:lo + 100]]

    files = ((norms[order[lo]], lambda lo=lo: blocks(order[lo:lo + 1500])) for lo in range(0, 9000, 1500))
    s, i = top_k_of_blocks(users, files, 10, np.arange(10), scored)
    want_s, want_i = top_k(users, items, ids, 10)
    assert np.allclose(s, want_s, rtol=1e-5) and (i == want_i).mean() > 0.999
    assert sum(read) < 9000 and scored[0] < 3000 * 9000 / 2


def test_users_of_zero_vectors_are_not_scored():
    """Every item scores 0 for them, so no bound ends their search: their lists are the lowest ids."""
    import numpy as np

    from recsift.functions.topk import top_k, top_k_of_blocks

    rng = np.random.default_rng(5)
    items = rng.normal(size=(5000, 4)).astype(np.float32) * rng.pareto(1.5, size=(5000, 1)).astype(np.float32)
    ids, users, zero, scored = rng.permutation(5000) + 7, rng.normal(size=(50, 4)).astype(np.float32), [3, 20], []
    users[zero] = 0
    order = np.argsort(-np.linalg.norm(items, axis=1))
    top = float(np.linalg.norm(items[order[0]]))
    s, i = top_k(users, items, ids, 6, scored=scored)
    t, j = top_k_of_blocks(users, [(top, lambda: iter([(ids[order], items[order])]))], 6, np.arange(7, 13), scored)
    rest, _ = top_k(np.delete(users, zero, axis=0), items, ids, 6, scored=scored)
    assert (s[zero] == 0).all() and (i[zero] == np.arange(7, 13)).all() and (i == j).all() and np.allclose(s, t)
    assert np.allclose(np.delete(s, zero, axis=0), rest) and scored[0] == scored[1] == scored[2]
