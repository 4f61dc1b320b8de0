"""Model compositions: grid search, fusion-weight search, final test."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recsift.operators import ALSSpec, eval_users, explode_recs, fit_als, recommend, true_labels
from recsift.plans import PrepareSpec, final_test, prepare, train_eval, tune_grid, tune_weight
from recsift.plans.tuning import WEIGHTS, weight_metrics
from recsift.sources import interactions

SPEC = ALSSpec(rank=4, max_iter=3, seed=42)
METRICS = {"map", "ndcg_at_k", "precision_at_k", "n_users_evaluated", "n_users_with_labels"}


@pytest.fixture(scope="module")
def splits(spark):
    return prepare(interactions(spark, SF001), PrepareSpec(low_threshold=2)).persist()


def _cached(spark) -> int:
    """Persisted RDDs other than the ALS models' own factor tables."""
    rdds = spark.sparkContext._jsc.getPersistentRDDs()  # noqa: SLF001
    return sum(1 for key in rdds.keySet().toArray() if "Factors" not in str(rdds[key].name()))


def test_tune_grid_covers_every_point(splits):
    out = tune_grid(splits, (3, 4), (0.01, 1.0), 5, SPEC).collect()
    assert sorted((r["rank"], r["reg"]) for r in out) == [(3, 0.01), (3, 1.0), (4, 0.01), (4, 1.0)]
    assert all(r["k"] == 5 for r in out)                 # k is passed through
    assert all(0 <= r["map"] <= 1 and 0 <= r["precision_at_k"] <= 1 for r in out)


def test_train_eval_one_row(splits):
    out = train_eval(splits, SPEC, 5)
    assert METRICS <= set(out.columns)
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["model_type"] == "explicit"


def test_tune_weight_matches_direct_fusion(spark, splits):
    got = {r["weight"]: r for r in tune_weight(splits, SPEC, 5).collect()}
    assert sorted(got) == sorted(WEIGHTS)
    train = splits.filter(F.col("split") == "train")
    val = splits.filter(F.col("split") == "val")
    users = eval_users(val)
    rat = explode_recs(recommend(fit_als(train, SPEC), users, 5))
    rev = explode_recs(recommend(fit_als(train, ALSSpec(rank=4, max_iter=3, seed=42,
                                                        implicit=True)), users, 5))
    direct = {r["weight"]: r for r in weight_metrics(rat, rev, true_labels(val), 5).collect()}
    for w in WEIGHTS:
        for m in ("map", "ndcg_at_k", "precision_at_k", "n_users_evaluated"):
            assert got[w][m] == pytest.approx(direct[w][m], abs=1e-9)


def test_final_test_basic_and_hybrid_and_releases_inputs(spark, splits):
    before = _cached(spark)
    out = final_test(splits, SPEC, 5, weight=1.0).collect()
    assert sorted(r["model"] for r in out) == ["basic", "hybrid"]
    assert {r["weight"] for r in out} == {None, 1.0}
    assert _cached(spark) == before                     # nothing is left in executor memory


def test_final_test_picks_weight_on_val(splits):
    out = final_test(splits, SPEC, 5).collect()
    hybrid = [r for r in out if r["model"] == "hybrid"]
    assert len(hybrid) == 1 and hybrid[0]["weight"] in WEIGHTS


def test_plans_append_to_one_runs_table(spark, splits):
    import tempfile

    from recsift.plans.tuning import RUN_COLUMNS

    path = tempfile.mkdtemp(prefix="recsift-runs-", dir="/tmp") + "/runs"
    train_eval(splits, SPEC, 5, runs_path=path, tags={"fraction": 1.0})
    final_test(splits, SPEC, 5, weight=0.5, runs_path=path, tags={"fraction": 1.0})
    runs = spark.read.parquet(path)
    assert runs.columns == [c for c, _ in RUN_COLUMNS] + ["tags", "run_at"]
    got = sorted((r.plan, r.model, r.weight) for r in runs.collect())
    assert got == [("final_test", "basic", None), ("final_test", "hybrid", 0.5),
                   ("train_eval", None, None)]
    assert {r.tags["fraction"] for r in runs.collect()} == {"1.0"}


def test_final_test_with_store_fits_once(spark, splits):
    import os
    import tempfile

    from recsift.session import checkpoint_dir

    store = "test-store-" + tempfile.mkdtemp(dir="/tmp")
    root = f"{checkpoint_dir(spark)}/recsift"

    def artefacts():
        return sorted(os.listdir(f"{root}/{kind}") if os.path.isdir(f"{root}/{kind}") else []
                      for kind in ("als", "recs"))

    before = artefacts()
    first = sorted(map(tuple, final_test(splits, SPEC, 5, weight=1.0, store=store).collect()))
    after_first = artefacts()
    second = sorted(map(tuple, final_test(splits, SPEC, 5, weight=1.0, store=store).collect()))
    assert first == second
    assert after_first != before and artefacts() == after_first   # nothing refitted
    assert sum(map(len, after_first)) - sum(map(len, before)) == 4  # 2 models + 2 lists


def test_grid_deals_the_ratings_once(splits, monkeypatch):
    from dataclasses import replace

    from recsift.plans import tuning

    dealt, deal_both = [], tuning.deal_both
    monkeypatch.setattr(tuning, "deal_both", lambda ratings, parts: dealt.append(parts) or deal_both(ratings, parts))
    out = tune_grid(splits, (3, 4), (0.01, 1.0), 5, replace(SPEC, max_iter=1, solver="gram")).collect()
    assert len(out) == 4 and len(dealt) == 1
