"""CSV quarantine, committed runs, label arrays, a grid that resumes."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from recsift.operators import ALSSpec, SplitSpec, label_arrays, remove_zeros, split
from recsift.operators import metrics as metrics_mod
from recsift.plans import tune_grid
from recsift.plans import tuning as tuning_mod
from recsift.sources import commit_runs, interactions, materialize, read_runs, scan_csv


def test_every_csv_record_is_kept_or_rejected(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.mkdir()
    (path / "a.csv").write_text("user_id,item_id,is_read,rating,is_reviewed\n1,2,1,5,0\n99999999999,2,1,5,0\nabc,2,1,5,0\n"
                                "1,3,1,five,0\n,4,1,5,0\n1,5,1,,0\n")
    (path / "b.csv").write_text('user_id,item_id,is_read,rating,is_reviewed\n2,2,1,4,0\n2,3,1\n2,4,1,4,0,extra\n"3","5",0,0,1\n')
    scan = scan_csv(spark, str(path))
    assert sorted((r.user_id, r.item_id, r.rating) for r in scan.rows.collect() if r.rating is not None) == [
        (1, 2, 5), (2, 2, 4), (3, 5, 0)]
    assert scan.rows.filter("rating is null").count() == 1  # a missing rating is no bad record
    bad = {(r.file.rsplit("/", 1)[1], r.record, r.reason) for r in scan.rejected.collect()}
    assert bad == {("a.csv", "99999999999,2,1,5,0", "malformed"), ("a.csv", "abc,2,1,5,0", "malformed"),
                   ("a.csv", "1,3,1,five,0", "malformed"), ("a.csv", ",4,1,5,0", "no id"),
                   ("b.csv", "2,3,1", "malformed"), ("b.csv", "2,4,1,4,0,extra", "malformed")}
    balance = {r.status: r.n_rows for r in scan.balance().collect()}
    assert balance == {"kept": 4, "malformed": 5, "no id": 1} and scan.n_read == 10
    with pytest.raises(ValueError):
        scan_csv(spark, str(path), "other")


def test_a_retried_run_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    with pytest.raises(FileNotFoundError):
        read_runs(spark, path)
    commit_runs(spark.range(3), path, "a")
    commit_runs(spark.range(99), path, "a")  # the retry of a committed run
    spark.range(5).write.parquet(f"{path}/run=b")
    (tmp_path / "runs" / "run=b" / "_SUCCESS").unlink()  # a driver was lost while writing
    assert sorted(map(tuple, read_runs(spark, path).collect())) == [(0, "a"), (1, "a"), (2, "a")]
    commit_runs(spark.range(2).withColumn("more", F.lit(1)), path, "b")
    assert read_runs(spark, path).filter("run = 'b'").count() == 2 and read_runs(spark, path).count() == 5
    with pytest.raises(ValueError):
        commit_runs(spark.range(1), path, "a/b")


@pytest.mark.parametrize("stretch", [1024, 8])
def test_label_arrays_of_a_hot_user(spark, monkeypatch, stretch):
    monkeypatch.setattr(metrics_mod, "LABEL_CHUNK", stretch)
    rows = [(1, 7 * i) for i in range(500)] + [(u, u % 5) for u in range(2, 40)] + [(None, 1), (2, None)]
    labels = spark.createDataFrame(rows, "user_id int, item_id int")
    got = {(r.user_id, r.chunk): r["items"] for r in label_arrays(labels, 64).collect()}
    assert [x for c in range(8) for x in got[1, c]] == [7 * i for i in range(500)]
    assert max(map(len, got.values())) == 64 and len(got) == 8 + 38
    assert label_arrays(labels.limit(0)).collect() == []
    with pytest.raises(ValueError):
        label_arrays(labels, 0)


def test_a_stopped_grid_refits_only_what_is_missing(spark, tmp_path, monkeypatch):
    rows = materialize(split(remove_zeros(interactions(spark, SF001)), SplitSpec()), str(tmp_path / "s"), sort_by=())
    base, grid = ALSSpec(max_iter=1, blocks=2, solver="gram"), {"ranks": (2, 3), "regs": (0.1, 1.0), "k": 5}
    alone = sorted(map(str, tune_grid(rows, base=base, at_once=1, **grid).collect()))
    store, fits = f"grid-{tmp_path.name}", []
    real = tuning_mod.get_recs_long

    def stops(train, users, spec, *args):
        if spec.rank == 2 and spec.reg == 1.0 and not fits:
            fits.append("lost")
            raise RuntimeError("the driver was lost")
        return real(train, users, spec, *args)

    monkeypatch.setattr(tuning_mod, "get_recs_long", stops)
    with pytest.raises(RuntimeError):
        tune_grid(rows, base=base, store=store, at_once=2, **grid)
    monkeypatch.setattr(tuning_mod, "get_recs_long", real)
    from recsift.plans import recs_store

    fit = recs_store.fit_als
    monkeypatch.setattr(recs_store, "fit_als", lambda train, spec, path: fits.append((spec.rank, spec.reg)) or fit(train, spec, path))
    runs = str(tmp_path / "runs")
    for _ in range(2):
        out = tune_grid(rows, base=base, store=store, at_once=2, runs_path=runs, tags={"run_id": "r1"}, **grid)
        assert sorted(map(str, out.collect())) == alone
    assert fits == ["lost", (2, 1.0)]
    assert read_runs(spark, runs).count() == 4  # the retried run is there once
