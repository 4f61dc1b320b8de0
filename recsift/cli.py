"""Command line for ``spark-submit``: the original tasks over the new plans.

    spark-submit recsift/cli.py test        <source> <fraction> <k> <rank> [--reg R] [--weight W]
    spark-submit recsift/cli.py tune        <source> <fraction> <k>
    spark-submit recsift/cli.py hybrid-tune <source> <fraction> <k> <rank> <reg>
    spark-submit recsift/cli.py save-splits <source>

``source`` is a folder of the driver tables (``lineitem``, ``orders``), a raw
interactions CSV export (``*.csv``) or an interactions Parquet table. The
splits of ``fraction`` are read from (or written once to) the shared
checkpoint folder, and so are the models and top-k lists (fit-or-load, keyed
by the data, the preparation and every model parameter). Every task appends
its metric rows to the runs table (``--runs``, default
``<checkpoint dir>/recsift/runs``) and prints them. The session comes from
``spark-submit``; on a cluster it must name ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from recsift.operators import ALSSpec  # noqa: E402
from recsift.plans import (  # noqa: E402
    PrepareSpec,
    final_test,
    prepared_table,
    save_fraction_splits,
    tune_grid,
    tune_weight,
)
from recsift.session import checkpoint_dir  # noqa: E402
from recsift.sources import source_key  # noqa: E402

SEED = 42
LOW = 10


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recsift")
    p.add_argument("--runs", default=None, help="runs table path")
    sub = p.add_subparsers(dest="task", required=True)
    t = sub.add_parser("test", help="final test: train+val -> test, basic and hybrid")
    t.add_argument("source"), t.add_argument("fraction", type=float), t.add_argument("k", type=int)
    t.add_argument("rank", type=int)
    t.add_argument("--reg", type=float, default=0.01)
    t.add_argument("--weight", type=float, default=None, help="fusion weight (default: chosen on val)")
    g = sub.add_parser("tune", help="grid search over rank x lambda")
    g.add_argument("source"), g.add_argument("fraction", type=float), g.add_argument("k", type=int)
    h = sub.add_parser("hybrid-tune", help="fusion weight search")
    h.add_argument("source"), h.add_argument("fraction", type=float), h.add_argument("k", type=int)
    h.add_argument("rank", type=int), h.add_argument("reg", type=float)
    s = sub.add_parser("save-splits", help="splits of every fraction as one table")
    s.add_argument("source")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"recsift-{args.task}").getOrCreate()
    runs = args.runs or f"{checkpoint_dir(spark)}/recsift/runs"
    if args.task == "save-splits":
        out = save_fraction_splits(spark, args.source, SEED, LOW)
        out.groupBy("split").count().show()
        return out
    splits = prepared_table(spark, args.source,
                            PrepareSpec(fraction=args.fraction, seed=SEED, low_threshold=LOW))
    tags = {"fraction": args.fraction, "source": args.source}
    # models and lists are fit-or-load, keyed by the data and the preparation
    store = f"{source_key(spark, args.source)}|fraction={args.fraction}|seed={SEED}|low={LOW}"
    if args.task == "test":
        out = final_test(splits, ALSSpec(rank=args.rank, reg=args.reg, seed=SEED), args.k,
                         weight=args.weight, runs_path=runs, tags=tags, store=store)
    elif args.task == "tune":
        out = tune_grid(splits, k=args.k, base=ALSSpec(seed=SEED), runs_path=runs, tags=tags,
                        store=store)
    else:
        out = tune_weight(splits, ALSSpec(rank=args.rank, reg=args.reg, seed=SEED), args.k,
                          runs_path=runs, tags=tags, store=store)
    out.show(truncate=False)
    return out


if __name__ == "__main__":
    main()
