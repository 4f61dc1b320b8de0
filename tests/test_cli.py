"""The command line maps the original tasks onto the plans."""

import tempfile

from conftest import SF001
from recsift.cli import main


def test_cli_test_and_hybrid_tune_write_runs(spark):
    runs = tempfile.mkdtemp(prefix="recsift-cli-", dir="/tmp") + "/runs"
    out = main(["--runs", runs, "test", SF001, "1.0", "5", "4", "--weight", "0.5"], spark)
    assert sorted(r.model for r in out.collect()) == ["basic", "hybrid"]
    main(["--runs", runs, "hybrid-tune", SF001, "1.0", "5", "4", "0.1"], spark)
    table = spark.read.parquet(runs)
    assert sorted(r.plan for r in table.select("plan").distinct().collect()) == \
        ["final_test", "tune_weight"]
    assert table.filter("plan = 'tune_weight'").count() == 5
    assert {r.tags["fraction"] for r in table.collect()} == {"1.0"}


def test_cli_rejects_unknown_task():
    import pytest

    with pytest.raises(SystemExit):
        main(["fit-everything", SF001])


def test_cli_save_splits(spark):
    out = main(["save-splits", SF001], spark)
    assert set(out.columns) >= {"user_id", "item_id", "split", "share"}
    assert out.filter("split = 'train'").count() > out.filter("split <> 'train'").count() > 0
