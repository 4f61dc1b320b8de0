import pytest
from pyspark.sql import functions as F

from conftest import SF01, sliding_rows
from recsift.functions.hashing import bucket
from recsift.operators import (
    SplitSpec,
    put_back,
    remove_zeros,
    split,
    tag_holdout,
)
from recsift.operators.quality import conservation, split_report
from recsift.plans import PrepareSpec, prepare, prepare_stepwise, split_fractions
from recsift.sources import interactions

SCHEMA = "user_id int, item_id int, rating int, is_reviewed int"


@pytest.fixture(scope="module")
def inter01(spark):
    return interactions(spark, SF01).persist()


def counts(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_golden_split_sf001(inter01):
    """All rated pairs at sf0.01, no low-user filter, no downsample."""
    s = split(remove_zeros(inter01))
    assert counts(s) == {"train": 38248, "val": 5179, "test": 5224}


def test_golden_thinned(inter01):
    """A thinned table where put-back and item removal both occur."""
    thin = remove_zeros(inter01).filter(bucket("thin", "user_id", "item_id") < 60)
    assert thin.count() == 2953
    tagged = tag_holdout(thin)
    moved = put_back(tagged)
    assert moved.filter(F.col("put_back") & F.col("held")).count() == 238
    s = split(thin)
    assert counts(s) == {"train": 2535, "val": 148, "test": 144}
    assert 2953 - s.count() == 126
    missing = conservation(thin, s)
    assert missing.filter(F.col("side") == "extra").count() == 0
    assert missing.filter(F.col("side") == "missing").count() == 126


def _invariants(s, n_input):
    rows = s.collect()
    assert len({(r.user_id, r.item_id) for r in rows}) == len(rows)  # disjoint on pairs
    train_users = {r.user_id for r in rows if r.split == "train"}
    train_items = {r.item_id for r in rows if r.split == "train"}
    held = [r for r in rows if r.split != "train"]
    assert {r.user_id for r in held} <= train_users
    assert {r.item_id for r in held} <= train_items
    val_users = {r.user_id for r in rows if r.split == "val"}
    test_users = {r.user_id for r in rows if r.split == "test"}
    assert not val_users & test_users
    assert len(rows) <= n_input


@pytest.mark.parametrize("seed", [1, 42, 7])
def test_split_invariants_fixture(spark, seed):
    rows = sliding_rows(n_users=60, n_items=39, dense_users=range(10, 31))
    df = remove_zeros(spark.createDataFrame(rows, SCHEMA))
    s = split(df, SplitSpec(seed=seed))
    _invariants(s, df.count())
    # nothing is lost except unobserved-item rows
    miss = conservation(df, s)
    assert miss.filter(F.col("side") == "extra").count() == 0


def test_split_independent_of_layout(spark):
    rows = sliding_rows(n_users=60, n_items=39, dense_users=range(10, 31))
    df = spark.createDataFrame(rows, SCHEMA)
    a = split(df.repartition(2)).collect()
    b = split(df.repartition(7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_split_without_unobserved_removal(spark):
    rows = sliding_rows(n_users=60, n_items=39)
    df = spark.createDataFrame(rows, SCHEMA)
    raw = split(df, rm_unobserved=False)
    assert raw.count() == len(rows)
    assert raw.filter((F.col("split") != "train") & ~F.col("held")).count() == 0


@pytest.mark.parametrize("spec", [
    PrepareSpec(fraction=1.0, low_threshold=10),
    PrepareSpec(fraction=0.3, low_threshold=5, seed=3),
    PrepareSpec(fraction=0.5, low_threshold=0),
    PrepareSpec(fraction=0.5, low_threshold=10, rm_unobserved=False),
    PrepareSpec(fraction=0.5, low_threshold=10, rm_zeros=False),
])
def test_fused_prepare_equals_stepwise(inter01, spec):
    thin = inter01.filter(bucket("thin", "user_id", "item_id") < 100)
    a = prepare(thin, spec)
    b = prepare_stepwise(thin, spec)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_fractions_match_prepare(inter01):
    thin = inter01.filter(bucket("thin", "user_id", "item_id") < 200)
    fr = (0.05, 0.3, 1.0)
    got = {(r.fraction, r.split): (r.n_rows, r.n_users)
           for r in split_fractions(thin, fr, 42, 3).collect()}
    for f in fr:
        rep = split_report(prepare(thin, PrepareSpec(fraction=f, low_threshold=3))).collect()
        for r in rep:
            assert got[(f, r.split)] == (r.n_rows, r.n_users)


@pytest.mark.parametrize("max_rows", [None, "0"])     # one broadcast pass / union fallback
def test_fraction_table_equals_prepare_rows(spark, inter01, max_rows):
    from recsift.plans import at_fraction, fraction_table

    if max_rows is not None:
        spark.conf.set("recsift.broadcast.maxRows", max_rows)
    try:
        thin = inter01.filter(bucket("thin", "user_id", "item_id") < 200)
        table = fraction_table(thin, 42, 3).persist()
        for f in (0.05, 0.3, 1.0):
            a = at_fraction(table, f)
            b = prepare(thin, PrepareSpec(fraction=f, low_threshold=3))
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        table.unpersist()
    finally:
        spark.conf.unset("recsift.broadcast.maxRows")


def test_save_fraction_splits_one_table(spark):
    from conftest import SF001
    from recsift.plans import at_fraction, save_fraction_splits

    t = save_fraction_splits(spark, SF001, seed=9, low_threshold=2)
    half = at_fraction(t, 0.5)
    want = prepare(interactions(spark, SF001), PrepareSpec(fraction=0.5, seed=9, low_threshold=2))
    assert half.exceptAll(want).count() == 0 and want.exceptAll(half).count() == 0


def test_quality_report_on_thinned_table(inter01):
    from recsift.operators import quality_report

    thin = remove_zeros(inter01).filter(bucket("thin", "user_id", "item_id") < 60)
    r = quality_report(thin, thin, split(thin)).collect()[0]
    assert (r.down_rows, r.split_rows, r.missing, r.extra) == (2953, 2827, 126, 0)
    assert (r.train_rows, r.val_rows, r.test_rows) == (2535, 148, 144)
    assert r.train_user_share == 1.0 and r.down_user_share == 1.0
    assert r.split_row_share == round(2827 / 2953, 9)
    assert r.full_duplicates == r.down_duplicates == r.split_duplicates == 0
    assert r.train_users == r.down_users > r.val_users + r.test_users


def test_unseen_users_hash_each_row_once(spark):
    """No filter on the role hashes the rows' users again; the users are the same."""
    from test_plans import formatted

    from recsift.operators.splits import tag_holdout, unseen_users

    rows = [(u, i, 4) for u in range(200) for i in range(u % 3 + 1)]
    tagged = tag_holdout(spark.createDataFrame(rows, "user_id int, item_id int, rating int"), SplitSpec(seed=3))
    held = {}
    for r in tagged.collect():
        held.setdefault(r.user_id, []).append(r.role != "train" and r.held)
    unseen = unseen_users(tagged)
    assert {r.user_id for r in unseen.collect()} == {u for u, h in held.items() if all(h)} != set()
    assert not [line for line in formatted(unseen).splitlines() if line.startswith("Condition") and "md5" in line]


def test_tagging_hashes_a_rows_user_once(spark):
    """One hash of the user and one of the pair in the plan, not one for each mention of the role."""
    df = spark.createDataFrame([(1, 2, 3)], "user_id int, item_id int, rating int")
    plan = tag_holdout(df, SplitSpec())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 2
