"""Model compositions: single train + evaluate, grid search, fusion-weight
search and the final test.

The driver only loops over parameter points (a handful), never over data. ``splits`` is read by every fit and evaluation, so
pass a written table (``prepared_table``). Derived frames read more than once
(eval users, labels, recommendation lists) are written once to the shared
checkpoint folder, and so are the results, small metric tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.gram_als import deal_both, sharing
from recsift.operators.hybrid import fuse_scores, topk_lists, weigh
from recsift.operators.joins import materialize_keys
from recsift.operators.metrics import eval_users, ranking_metrics, true_labels
from recsift.operators.read_als import sharing as sharing_reads
from recsift.operators.recs import ALSSpec, fit_als, recommend_long
from recsift.operators.splits import TEST, TRAIN, VAL
from recsift.plans.recs_store import get_recs_long
from recsift.sources.store import append_runs, commit_runs

WEIGHTS = [-1.0, 0.0, 0.5, 1.0, 5.0]


def _rows(splits: DataFrame, *which: str) -> DataFrame:
    return (splits.filter(F.col("split").isin(*which))
            .select("user_id", "item_id", "rating", "is_reviewed"))


def _params(df: DataFrame, spec: ALSSpec, k: int, **extra) -> DataFrame:
    cols = [F.lit(spec.model_type).alias("model_type"), F.lit(spec.rank).alias("rank"),
            F.lit(float(spec.reg)).alias("reg"), F.lit(k).alias("k")]
    cols += [F.lit(v).alias(n) for n, v in extra.items()]
    return df.select(*cols, "*")


# Columns of the runs table every plan appends to (missing ones are null).
RUN_COLUMNS = [("plan", "string"), ("model", "string"), ("weight", "double"),
               ("model_type", "string"), ("rank", "int"), ("reg", "double"), ("k", "int"),
               ("map", "double"), ("ndcg_at_k", "double"), ("precision_at_k", "double"),
               ("n_users_evaluated", "bigint"), ("n_users_with_labels", "bigint")]


def log_runs(result: DataFrame, runs_path: str | None, plan: str,
             tags: dict | None = None, part: str = "") -> DataFrame:
    """Result sink: append ``result`` to the runs table at ``runs_path`` in the
    shared layout of :data:`RUN_COLUMNS`, plus the caller's ``tags`` (for
    example the sample fraction) as text and the time of the run. Returns
    ``result`` unchanged; nothing is written when ``runs_path`` is None. With a
    ``run_id`` among the tags the rows are committed under it, plan and
    ``part``, once however often the run is retried (read by ``read_runs``)."""
    if runs_path is None:
        return result
    cols = []
    for name, kind in RUN_COLUMNS:
        if name == "plan":
            cols.append(F.lit(plan).alias(name))
        elif name in result.columns:
            cols.append(F.col(name).cast(kind).alias(name))
        else:
            cols.append(F.lit(None).cast(kind).alias(name))
    tag_map = F.create_map(*[F.lit(str(x)) for kv in sorted((tags or {}).items()) for x in kv]) \
        if tags else F.lit(None).cast("map<string,string>")
    rows = result.select(*cols, tag_map.alias("tags"), F.current_timestamp().alias("run_at"))
    if tags and "run_id" in tags:
        commit_runs(rows, runs_path, f"{tags['run_id']}-{plan}{part}")
    else:
        append_runs(rows, runs_path)
    return result


def _recs(train: DataFrame, users: DataFrame, spec: ALSSpec, k: int, store: str | None,
          trained_on: tuple[str, ...], users_key: str, model_path: str | None = None) -> DataFrame:
    """Top-k rows for ``users``; fit-or-load through the artefact store when
    ``store`` names the prepared data (models and lists keyed by it, by the
    splits trained on and by the evaluated split)."""
    if store is None:
        return recommend_long(fit_als(train, spec, model_path), users, k)
    return get_recs_long(train, users, spec, k, f"{store}|train={'+'.join(trained_on)}", users_key)


def train_eval(splits: DataFrame, spec: ALSSpec = ALSSpec(), k: int = 500,
               train_on=(TRAIN,), eval_on: str = VAL, model_path: str | None = None,
               runs_path: str | None = None, tags: dict | None = None,
               store: str | None = None) -> DataFrame:
    """Fit on ``train_on`` splits, recommend k items for the ``eval_on`` users and score them."""
    train = _rows(splits, *train_on)
    target = _rows(splits, eval_on)
    preds = _recs(train, eval_users(target), spec, k, store, tuple(train_on), eval_on, model_path)
    out = materialize_keys(_params(ranking_metrics(preds, true_labels(target), k), spec, k))
    return log_runs(out, runs_path, "train_eval", tags)


def tune_grid(splits: DataFrame, ranks: Sequence[int] = (10, 20, 100, 500),
              regs: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
              k: int = 500, base: ALSSpec = ALSSpec(), runs_path: str | None = None,
              tags: dict | None = None, store: str | None = None, at_once: int = 4) -> DataFrame:
    """Every (rank, reg) point: fit on train, evaluate on val at the requested k.

    ``at_once`` points are worked on side by side, each in a scheduler pool of
    its own (they share the cluster fairly where ``spark.scheduler.mode`` is
    FAIR; else the jobs of one fill the gaps of another). The rows are those
    of a run in sequence. With ``store`` models and lists are saved as each
    point finishes, so a grid that was stopped refits only what is missing;
    with ``runs_path`` the points are appended to the runs table, in their order.
    """
    spark = splits.sparkSession
    train = _rows(splits, TRAIN)
    target = _rows(splits, VAL)
    users = materialize_keys(eval_users(target))
    labels = materialize_keys(true_labels(target))
    points = [replace(base, rank=rank, reg=reg) for rank in ranks for reg in regs]

    def work(n: int) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"recsift-grid-{n % at_once}")
        preds = _recs(train, users, points[n], k, store, (TRAIN,), VAL)
        return materialize_keys(_params(ranking_metrics(preds, labels, k), points[n], k))

    out = None
    # the ratings are dealt once for all points
    with sharing(train, base, lambda *args: deal_both(*args)), ThreadPoolExecutor(max(1, at_once)) as pool:
        # the largest ranks take longest: they start first
        order = sorted(range(len(points)), key=lambda n: -points[n].rank)
        told = {n: pool.submit(inheritable_thread_target(spark)(work), n) for n in order}
        for n in range(len(points)):
            m = log_runs(told[n].result(), runs_path, "tune_grid", tags, f"-{n}")
            out = m if out is None else out.unionByName(m)
    return out


def _both_recs(train: DataFrame, users: DataFrame, spec: ALSSpec, k: int,
               store: str | None = None, trained_on: tuple[str, ...] = (TRAIN,),
               users_key: str = VAL):
    """Lists of the explicit and the implicit model, fitted side by side: the jobs of one fill the
    gaps of the other, and both share what follows the rows alone."""
    def work(implicit: bool) -> DataFrame:
        return materialize_keys(_recs(train, users, replace(spec, implicit=implicit), k, store, trained_on, users_key))

    columns = tuple(replace(spec, implicit=implicit).rating_col for implicit in (False, True))
    with sharing_reads(train, columns), ThreadPoolExecutor(2) as pool:
        rating, review = (pool.submit(inheritable_thread_target(train.sparkSession)(work), x) for x in (False, True))
        return rating.result(), review.result()


def weight_metrics(rating_long: DataFrame, review_long: DataFrame, labels: DataFrame,
                   k: int, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Metrics of the fused top-k list for every weight, in one job."""
    scored = weigh(fuse_scores(rating_long, review_long), list(weights))
    lists = topk_lists(scored, k, by=("weight",))
    return ranking_metrics(lists, labels, k, by=("weight",))


def tune_weight(splits: DataFrame, spec: ALSSpec = ALSSpec(), k: int = 500,
                weights: Sequence[float] = WEIGHTS, runs_path: str | None = None,
                tags: dict | None = None, store: str | None = None) -> DataFrame:
    """Fit the explicit and the implicit model once each, then score the fused
    lists for all weights together (fusion is the only thing that varies)."""
    train = _rows(splits, TRAIN)
    target = _rows(splits, VAL)
    users = materialize_keys(eval_users(target))  # read by both models
    rat, rev = _both_recs(train, users, spec, k, store, (TRAIN,), VAL)
    out = _params(weight_metrics(rat, rev, true_labels(target), k, weights),
                  replace(spec, implicit=False), k)
    return log_runs(materialize_keys(out), runs_path, "tune_weight", tags)


def final_test(splits: DataFrame, spec: ALSSpec = ALSSpec(), k: int = 500,
               weight: float | None = None, runs_path: str | None = None,
               tags: dict | None = None, store: str | None = None) -> DataFrame:
    """Train on train + val, evaluate on test: the basic (explicit) model and the
    hybrid list. With ``weight=None`` the fusion weight is chosen on val first
    (highest MAP, ties to the weight nearest 0); without any evaluated val user
    there is nothing to choose by, which is an error."""
    if weight is None:
        tuned = tune_weight(splits, spec, k, runs_path=runs_path, tags=tags, store=store) \
            .orderBy(F.desc("map"), F.abs("weight"), F.asc("weight")).first()
        if tuned is None:
            raise ValueError("no val user to choose the fusion weight on; give a weight")
        weight = float(tuned["weight"])
    train = _rows(splits, TRAIN, VAL)
    target = _rows(splits, TEST)
    users = materialize_keys(eval_users(target))  # read by both models
    labels = materialize_keys(true_labels(target))
    rat, rev = _both_recs(train, users, spec, k, store, (TRAIN, VAL), TEST)
    basic = ranking_metrics(rat.select("user_id", "pos", "item_id"), labels, k) \
        .select(F.lit("basic").alias("model"), F.lit(None).cast("double").alias("weight"), "*")
    hybrid = weight_metrics(rat, rev, labels, k, [weight]).select(F.lit("hybrid").alias("model"), "*")
    out = _params(basic.unionByName(hybrid), replace(spec, implicit=False), k)
    return log_runs(materialize_keys(out), runs_path, "final_test", tags)
