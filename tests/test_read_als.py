"""Spark ML's model of many ratings: its factors, and what a half-iteration shuffles."""

import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recsift.operators import ALSSpec, SplitSpec, fit_als, recommend_long, remove_zeros, split
from recsift.operators import gram_als, read_als
from recsift.operators.gram_als import FactorModel
from recsift.operators.read_als import fit_read_als, start_factors
from recsift.sources import interactions
from test_gram_als import _gap, _hot

SPEC = ALSSpec(rank=6, reg=0.05, max_iter=3, blocks=4, ml_ratings=0)


def _ml(train, spec):
    return fit_als(train, replace(spec, ml_ratings=None))


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize("table", ["plain", "hot"])
def test_factors_equal_spark_mls(spark, monkeypatch, implicit, table):
    monkeypatch.setattr(read_als, "SLICE_RATINGS", 50)  # several packs and slices
    monkeypatch.setattr(read_als, "BLOCK_FLOATS", 60)
    train = remove_zeros(interactions(spark, SF001)) if table == "plain" else _hot(spark)
    spec = replace(SPEC, implicit=implicit)
    own, ml = fit_als(train, spec), _ml(train, spec)
    assert isinstance(own, FactorModel) and not isinstance(ml, FactorModel)
    assert _gap(own.userFactors, ml.userFactors) < 1e-4
    assert _gap(own.itemFactors, ml.itemFactors) < 1e-4


def test_lists_equal_spark_mls(spark):
    train = remove_zeros(interactions(spark, SF001))
    users = train.select("user_id").distinct()
    lists = [{(r.user_id, r.pos): r.rating for r in recommend_long(m, users, 10).collect()}
             for m in (_ml(train, SPEC), fit_als(train, SPEC))]
    assert lists[0].keys() == lists[1].keys()
    assert max(abs(lists[0][x] - lists[1][x]) for x in lists[0]) < 1e-3


@pytest.mark.parametrize("implicit", [False, True])
def test_start_is_spark_mls(spark, implicit):
    train, spec = _hot(spark), replace(SPEC, implicit=implicit)
    own = start_factors(train.select(F.col("user_id").alias("id")).distinct(), spec)
    assert _gap(own, _ml(train, replace(spec, max_iter=0)).userFactors) == 0


def test_more_groups_change_nothing(spark, monkeypatch):
    train = _hot(spark)
    one = fit_read_als(train, SPEC)
    monkeypatch.setattr(read_als, "n_groups", lambda ratings, spec: 11)
    many = fit_read_als(train, SPEC)
    assert _gap(one.userFactors, many.userFactors) == 0 and _gap(one.itemFactors, many.itemFactors) == 0


def test_a_half_iteration_shuffles_nothing(spark, monkeypatch):
    """Factors are read where they were written; the ratings stay cached in their groups."""
    halves, run = [], read_als._half
    monkeypatch.setattr(read_als, "_half", lambda files, spec: halves.append(files) or run(files, spec))
    plans, deal = [], read_als.deal
    monkeypatch.setattr(read_als, "deal", lambda *a: plans.append(deal(*a)) or plans[-1])
    fit_read_als(_hot(spark), SPEC)
    assert len(halves) == 2 * SPEC.max_iter and all(halves)
    for side in plans:
        plan = side.persist()._jdf.queryExecution().executedPlan().toString()
        side.unpersist()
        assert plan.split("InMemoryRelation")[0].count("Exchange") == 0
        assert side.rdd.getNumPartitions() == SPEC.blocks


def test_a_lost_block_is_an_error():
    with pytest.raises(ValueError, match="0 of 3 factors"):
        read_als._read([], np.array([1, 2, 3], dtype="<i4"), 4)


def test_saved_factors_are_read_back(spark, tmp_path, monkeypatch):
    train, path = _hot(spark), str(tmp_path / "model")
    first = fit_als(train, SPEC, path)
    monkeypatch.setattr(read_als, "fit_read_als", None)
    again = fit_als(train, SPEC, path)
    assert again.rank == SPEC.rank and _gap(first.userFactors, again.userFactors) == 0


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize("table", ["plain", "hot"])
def test_large_gram_fits_send_no_factors(spark, monkeypatch, implicit, table):
    """Factors beyond the bound are written and read; with hot ids, too, they are those that are sent."""
    train = remove_zeros(interactions(spark, SF001)) if table == "plain" else _hot(spark)
    spec = replace(SPEC, implicit=implicit, solver="gram", blocks=40 if table == "hot" else 4)
    sent = fit_als(train, spec)
    monkeypatch.setattr(gram_als, "READ_FLOATS", 0)
    monkeypatch.setattr(gram_als, "_step", None)
    monkeypatch.setattr(read_als, "SLICE_RATINGS", 50)
    folders, keep = [], read_als.fit_folder
    monkeypatch.setattr(read_als, "fit_folder", lambda s: folders.append(keep(s)) or folders[-1])
    read = fit_als(train, spec)
    assert _gap(sent.userFactors, read.userFactors) < 1e-4 and _gap(sent.itemFactors, read.itemFactors) < 1e-4
    left = {p.split("-hot")[0] for p in os.listdir(folders[0].removeprefix("file:").replace("///", "/"))}
    assert left == {f"items-{SPEC.max_iter - 1}", f"users-{SPEC.max_iter - 1}"}


def test_grid_of_large_fits_deals_once(spark, monkeypatch):
    from recsift.plans import tune_grid

    monkeypatch.setattr(gram_als, "READ_FLOATS", 0)
    dealt, deal = [], read_als.deal
    monkeypatch.setattr(read_als, "deal", lambda *a: dealt.append(a) or deal(*a))
    rows = split(remove_zeros(interactions(spark, SF001)), SplitSpec())
    out = tune_grid(rows, (3, 4), (0.01, 1.0), 5, replace(SPEC, max_iter=1, solver="gram")).collect()
    assert len(out) == 4 and len(dealt) == 2


def test_groups_leave_no_core_idle():
    assert [read_als.even(16, c) for c in (4, 8, 12, 16, 100)] == [16, 16, 24, 16, 16]


def _with_nulls(train):
    return train.withColumn("is_reviewed", F.when(F.col("item_id") % 7 > 0, F.col("is_reviewed")))


@pytest.mark.parametrize("nulls", [False, True])
def test_explicit_and_implicit_share_dealt_ratings_and_start(spark, monkeypatch, nulls):
    """Rows with a null in one column are other rows for each model: nothing is shared then."""
    train = _with_nulls(_hot(spark)) if nulls else _hot(spark)
    specs = [replace(SPEC, implicit=implicit) for implicit in (False, True)]
    alone = [fit_read_als(train, spec) for spec in specs]
    dealt, started, deal, start = [], [], read_als.deal, read_als.start_factors
    monkeypatch.setattr(read_als, "deal", lambda *a: dealt.append(a) or deal(*a))
    monkeypatch.setattr(read_als, "start_factors", lambda *a: started.append(a) or start(*a))
    with read_als.sharing(train, ("rating", "is_reviewed")):
        both = [fit_read_als(train, spec) for spec in specs]
    assert (len(dealt), len(started)) == ((4, 2) if nulls else (2, 1))
    for a, b in zip(alone, both, strict=True):
        assert _gap(a.userFactors, b.userFactors) < 1e-5 and _gap(a.itemFactors, b.itemFactors) < 1e-5


def test_weight_search_deals_the_rows_once(spark, monkeypatch):
    from recsift.plans import tune_weight

    dealt, deal = [], read_als.deal
    monkeypatch.setattr(read_als, "deal", lambda *a: dealt.append(a) or deal(*a))
    rows = split(remove_zeros(interactions(spark, SF001)), SplitSpec()).persist()
    one, other = (sorted(map(str, tune_weight(rows, replace(SPEC, ml_ratings=m), 5).collect())) for m in (0, None))
    assert len(dealt) == 2 and [x[:60] for x in one] == [x[:60] for x in other]
    rows.unpersist()
