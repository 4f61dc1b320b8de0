"""

``entry(spark)`` runs the flagship (final test: basic and hybrid model on the
test split) on sf0.001. ``queries()`` maps every implemented operator to a
``(spark, sf_dir) -> DataFrame`` callable over the driver's tables;
``oracle_sql()`` gives the DuckDB twin for each one SQL can express. ALS
output is not reproducible by another engine, so a model's query returns what
must hold for any model (list facts, parameters, user counts, metrics in
range), which has a twin; the ``*_rows`` and ``*_metrics`` queries return the
model's own output and have none.

Every query reads ``lineitem`` and ``orders`` in full (the interaction table
is derived from them, once per query) and works over all of their rows.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recsift import sql_twins as T  # noqa: E402
from recsift.functions.hashing import bucket  # noqa: E402
from recsift.operators.gram_als import fit_gram_als  # noqa: E402
from recsift.operators import (  # noqa: E402
    ALSSpec,
    SplitSpec,
    assign_roles,
    collect_recs,
    conservation,
    downsample_users,
    duplicate_pairs,
    eval_users,
    explode_recs,
    fit_als,
    fuse_scores,
    item_visibility_rows,
    label_arrays,
    per_user_metrics,
    popularity_recs,
    pred_labels,
    put_back,
    quality_report,
    ranking_metrics,
    recommend_long,
    remove_low_users,
    remove_zeros,
    review_split,
    split,
    split_report,
    split_view,
    tag_holdout,
    topk_lists,
    topk_lists_running,
    train_rows,
    true_labels,
)
from recsift.plans import (  # noqa: E402
    PrepareSpec,
    at_fraction,
    get_model,
    get_recs_long,
    merge_delta,
    fraction_table,
    final_test,
    prepare,
    prepared_table,
    read_split,
    split_fractions,
    train_eval,
    tune_grid,
    tune_weight,
)
from recsift.plans.tuning import WEIGHTS, weight_metrics  # noqa: E402
from recsift.session import checkpoint_dir  # noqa: E402
from recsift.sources import (  # noqa: E402
    decode_ids,
    encode_ids,
    id_map,
    interaction_rows,
    interactions,
    interactions_table,
    commit_runs,
    materialize,
    one_row_per_pair,
    read_runs,
    scan_csv,
)

# Parameters of the registered queries.
SEED = 42
LOW = 10            # keep users with more than LOW rated rows
K = 10              # list length
REG = 0.01          # ALS regularisation of the model queries
DOWN_FRACTION = 0.25
PREPARE_FRACTION = 0.5
FUSE_WEIGHT = 0.5
LABELS_IN_ARRAY = 8  # few, so that users have several arrays here
FRACTIONS = (0.01, 0.05, 0.25, 1.0)
TRIPLE = ["user_id", "item_id", "rating"]
# Few train users and a large holdout: users lose all rows, items are unseen.
SPARSE = SplitSpec(seed=SEED, train_share=20, val_share=490, holdout=950)
GRID_SPEC = ALSSpec(seed=SEED, solver="gram")
GRID_RANKS, GRID_REGS = (10, 20, 100, 500), (0.01, 0.1, 1.0, 10.0)


# ---------------------------------------------------------------- shared plans
# A query's split is built once, from an interaction table that is written once
# to a folder of its own; every later step reads the written tables.

def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/recsift-run/{uuid.uuid4().hex}"


def _inter(spark, sf):
    return interactions_table(spark, sf, root=_folder(spark))


def _kept(spark, sf):
    """Split input: zeros removed, low-activity users removed."""
    return remove_low_users(remove_zeros(_inter(spark, sf)), LOW)


def _written(df):
    return materialize(df, f"{_folder(df.sparkSession)}/table", sort_by=())


def _splits(spark, sf, spec=SplitSpec(seed=SEED)):
    return _written(split(_kept(spark, sf), spec))


def _val(s):
    return split_view(s, "val", ("user_id", "item_id", "rating", "is_reviewed"))


def _train(s):
    return split_view(s, "train", ("user_id", "item_id", "rating", "is_reviewed"))


def _pop_recs(s, by):
    return popularity_recs(_train(s), eval_users(split_view(s, "val")), K, by)


def _pop_preds(s):
    return pred_labels(_pop_recs(s, "rating"))


def _fused(s, weight=FUSE_WEIGHT):
    return fuse_scores(explode_recs(_pop_recs(s, "rating")), explode_recs(_pop_recs(s, "review")), weight)


def _per_user(s):
    return per_user_metrics(_pop_preds(s), true_labels(_val(s)), K)


def _als_rows(s, implicit, solver="ml"):
    model = fit_als(_train(s), ALSSpec(implicit=implicit, reg=REG, seed=SEED, solver=solver))
    return recommend_long(model, eval_users(split_view(s, "val")), K)


def _list_facts(rows, train):
    """What holds for the lists of any model: per user, items, distinct items,
    whether all are train items, positions run from 1, scores never rise."""
    known = train.select("item_id").distinct().withColumn("known", F.lit(True))
    w = Window.partitionBy("user_id").orderBy("pos")
    marked = rows.join(known, "item_id", "left") \
        .withColumn("before", F.lag("rating").over(w))
    return marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("item_id").alias("n_distinct"),
        (F.count("known") == F.count(F.lit(1))).alias("all_in_train"),
        ((F.min("pos") == 1) & (F.max("pos") == F.count(F.lit(1)))
         & (F.countDistinct("pos") == F.count(F.lit(1)))).alias("positions_run"),
        F.min(F.coalesce(F.col("before") >= F.col("rating"), F.lit(True))).alias("scores_fall"))


def _figures(metrics, *params):
    """Parameters and user counts of a metric table, and whether every metric is in range."""
    inside = lambda c: F.col(c).between(0.0, 1.0)
    return metrics.select(*params, "n_users_evaluated", "n_users_with_labels",
                          (inside("map") & inside("ndcg_at_k") & inside("precision_at_k")).alias("in_range"))


# ---------------------------------------------------------------- queries

def q_interactions(spark, sf):
    return interactions(spark, sf)


def q_remove_zeros(spark, sf):
    return remove_zeros(interactions(spark, sf))


def q_remove_low_users(spark, sf):
    return _kept(spark, sf).select(*TRIPLE)


def q_downsample_users(spark, sf):
    return downsample_users(remove_zeros(interactions(spark, sf)), DOWN_FRACTION, SEED).select(*TRIPLE)


def q_id_map(spark, sf):
    """Dense ids of users and items: how many, whether they run from 0, and
    whether mapping the rows there and back keeps them all."""
    rows = _inter(spark, sf).select("user_id", "item_id")
    out = None
    for column in rows.columns:
        mapping = id_map(rows, column)
        back = decode_ids(encode_ids(rows, mapping, column), mapping, column)
        facts = mapping.agg(F.lit(column).alias("kind"), F.count("id").alias("n_ids"),
                            F.countDistinct("dense").alias("n_dense"), F.min("dense").alias("first"),
                            F.max("dense").alias("last"))
        sums = back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(column).cast("bigint")).alias("id_sum"))
        facts = facts.select("*", sums.select("n_rows").scalar().alias("n_rows"),
                             sums.select("id_sum").scalar().alias("id_sum"))
        out = facts if out is None else out.unionByName(facts)
    return out


def q_split_users(spark, sf):
    return assign_roles(_kept(spark, sf), SplitSpec(seed=SEED)).select(*TRIPLE, "role")


def _tagged(spark, sf, spec=SplitSpec(seed=SEED)):
    return tag_holdout(_kept(spark, sf), spec)


def q_holdout_rows(spark, sf):
    return _tagged(spark, sf).filter(F.col("held")).select(*TRIPLE, "role")


def q_train_rows(spark, sf):
    return train_rows(_tagged(spark, sf)).select(*TRIPLE)


def q_putback_users(spark, sf):
    moved = put_back(_tagged(spark, sf, SPARSE))
    return moved.filter(F.col("put_back") & F.col("held")).select(*TRIPLE, "role")


def q_drop_unobserved_items(spark, sf):
    moved = put_back(_tagged(spark, sf, SPARSE))
    return item_visibility_rows(moved, keep=False).select(*TRIPLE, "split")


def q_splits(spark, sf):
    return split(_kept(spark, sf), SplitSpec(seed=SEED)).select(*TRIPLE, "is_reviewed", "split")


def q_splits_raw(spark, sf):
    return split(_kept(spark, sf), SplitSpec(seed=SEED), rm_unobserved=False) \
        .select(*TRIPLE, "is_reviewed", "split")


def q_prepare(spark, sf):
    return prepare(_inter(spark, sf), PrepareSpec(fraction=PREPARE_FRACTION, seed=SEED,
                                                  low_threshold=LOW))


def q_materialize_roundtrip(spark, sf):
    return prepared_table(spark, sf, PrepareSpec(seed=SEED, low_threshold=LOW)) \
        .select(*TRIPLE, "is_reviewed", "split")


def q_fraction_splits(spark, sf):
    return at_fraction(fraction_table(_inter(spark, sf), SEED, LOW), DOWN_FRACTION)


def q_split_fractions(spark, sf):
    return split_fractions(_inter(spark, sf), FRACTIONS, SEED, LOW)


def q_split_report(spark, sf):
    return split_report(_splits(spark, sf))


def q_quality_report(spark, sf):
    # "full" is the table as stored: mapped rows before the one-row-per-pair rule
    full = _written(interaction_rows(spark, sf))
    inter = one_row_per_pair(full)
    down = _written(downsample_users(remove_low_users(remove_zeros(inter), LOW), PREPARE_FRACTION, SEED))
    splits = _written(prepare(inter, PrepareSpec(fraction=PREPARE_FRACTION, seed=SEED, low_threshold=LOW)))
    return quality_report(full, down, splits)


def q_conservation(spark, sf):
    kept = _written(_kept(spark, sf))
    return conservation(kept, _written(split(kept, SPARSE)))


def q_duplicate_pairs(spark, sf):
    return duplicate_pairs(interaction_rows(spark, sf))


def q_train_plus_val(spark, sf):
    s = _splits(spark, sf)
    return split_view(s, "train").unionByName(split_view(s, "val"))


def q_review_split(spark, sf):
    return review_split(_splits(spark, sf), "train")


def q_eval_users(spark, sf):
    return eval_users(_val(_splits(spark, sf)))


def q_true_labels(spark, sf):
    return true_labels(_val(_splits(spark, sf)))


def q_pred_labels(spark, sf):
    return _pop_preds(_splits(spark, sf))


def q_explode_recs(spark, sf):
    return explode_recs(_pop_recs(_splits(spark, sf), "rating"))


def q_map_metric(spark, sf):
    return _per_user(_splits(spark, sf)).select("user_id", F.round("ap", 9).alias("ap"))


def q_ndcg_at_k(spark, sf):
    return _per_user(_splits(spark, sf)).select("user_id", F.round("ndcg", 9).alias("ndcg"))


def q_precision_at_k(spark, sf):
    return _per_user(_splits(spark, sf)).select("user_id", F.round("precision", 9).alias("precision"))


def q_ranking_metrics(spark, sf):
    s = _splits(spark, sf)
    return ranking_metrics(_pop_preds(s), true_labels(_val(s)), K)


def q_fuse_scores(spark, sf):
    return _fused(_splits(spark, sf))


def q_topk_lists(spark, sf):
    return topk_lists(_fused(_splits(spark, sf)), K)


def q_topk_lists_running(spark, sf):
    return topk_lists_running(_fused(_splits(spark, sf)), K)


def q_hybrid_topk(spark, sf):
    s = _splits(spark, sf)
    return ranking_metrics(topk_lists(_fused(s), K), true_labels(_val(s)), K)


def q_tune_weight_lists(spark, sf):
    s = _splits(spark, sf)
    return weight_metrics(explode_recs(_pop_recs(s, "rating")), explode_recs(_pop_recs(s, "review")),
                          true_labels(_val(s)), K, WEIGHTS)


def q_als_topk_explicit(spark, sf):
    s = _splits(spark, sf)
    return _list_facts(_als_rows(s, False), _train(s))


def q_als_topk_implicit(spark, sf):
    s = _splits(spark, sf)
    return _list_facts(_als_rows(s, True), _train(s))


def q_als_topk_explicit_rows(spark, sf):
    return _als_rows(_splits(spark, sf), False)


def q_als_topk_implicit_rows(spark, sf):
    return _als_rows(_splits(spark, sf), True)


def q_als_gram_topk_explicit(spark, sf):
    s = _splits(spark, sf)
    return _list_facts(_als_rows(s, False, "gram"), _train(s))


def q_als_gram_topk_implicit(spark, sf):
    s = _splits(spark, sf)
    return _list_facts(_als_rows(s, True, "gram"), _train(s))


def q_als_gram_parity(spark, sf):
    """Spark ML itself and `gram` from the same start: ids of each factor table, and how many
    have factors that differ by at most 1e-4."""
    train, out = _train(_splits(spark, sf)), None
    for implicit in (False, True):
        spec = ALSSpec(implicit=implicit, reg=REG, seed=SEED, ml_ratings=None)
        start = fit_als(train, replace(spec, max_iter=0)).userFactors
        own, ml = fit_gram_als(train, spec, start), fit_als(train, spec)
        for side in ("userFactors", "itemFactors"):
            other = getattr(ml, side).select("id", F.col("features").alias("other"))
            gap = F.array_max(F.zip_with("features", "other", lambda x, y: F.abs(x - y)))
            row = getattr(own, side).join(other, "id", "full").agg(
                F.count("id").alias("n_ids"), F.count(F.when(gap <= 1e-4, 1)).alias("n_close")) \
                .select(F.lit(spec.model_type).alias("model_type"), F.lit(side).alias("side"), "n_ids", "n_close")
            out = row if out is None else out.unionByName(row)
    return out


def q_label_arrays(spark, sf):
    arrays = label_arrays(true_labels(_val(_splits(spark, sf))), LABELS_IN_ARRAY)
    return arrays.select("user_id", "chunk", F.array_join("items", ",").alias("items"))


def _export(spark, sf):
    """A CSV export of the interaction rows; every 97th user's ratings are
    words, every 89th item's user ids are too long, every 83rd's are missing."""
    r = interaction_rows(spark, sf)
    item = F.col("item_id")
    user = F.when(item % 89 == 0, F.lit("99999999999")).when(item % 83 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string"))
    rating = F.when(F.col("user_id") % 97 == 0, F.lit("five")).otherwise(F.col("rating").cast("string"))
    path = f"{_folder(spark)}/export.csv"
    r.select(user.alias("user_id"), "item_id", "is_read", rating.alias("rating"), "is_reviewed") \
        .write.csv(path, header=True)
    return path


def q_csv_scan(spark, sf):
    """What a CSV export's scan keeps, summed up, and what it rejects, by reason."""
    scan = scan_csv(spark, _export(spark, sf))
    sums = scan.rows.agg(*[F.sum(c).alias(f"sum_{c}") for c in ("user_id", "item_id", "rating")])
    none = [F.lit(None).cast("bigint").alias(c) for c in sums.columns]
    kept = scan.balance().filter("status = 'kept'").select(
        "*", *[sums.select(c).scalar().alias(c) for c in sums.columns])
    return kept.unionByName(scan.balance().filter("status <> 'kept'").select("*", *none))


def q_runs_table(spark, sf):
    """Two runs of the weight search committed to a runs table, the first of
    them twice, as a retry does."""
    metrics, path = _written(q_tune_weight_lists(spark, sf)), f"{_folder(spark)}/runs"
    for run in ("first", "second", "first"):
        commit_runs(metrics, path, run)
    return read_runs(spark, path)


def q_recs_roundtrip(spark, sf):
    """Lists fitted, committed and read back from the store: per user, how many
    entries, and how many are the same when the same lists are asked for again."""
    s, key = _splits(spark, sf), _folder(spark)
    ask = lambda: get_recs_long(_train(s), eval_users(split_view(s, "val")),
                                ALSSpec(reg=REG, seed=SEED), K, key, "val")
    first, again = ask(), ask().withColumn("same", F.lit(1))
    return first.join(again, ["user_id", "pos", "item_id", "rating"], "full").groupBy("user_id").agg(
        F.count("pos").alias("n_items"), F.count("same").alias("n_same"))


def q_model_roundtrip(spark, sf):
    """Models of both kinds and both solvers, committed and loaded: ids of each
    factor table, and how many of them have the saved factors."""
    train, out = _train(_splits(spark, sf)), None
    for spec in (ALSSpec(reg=REG, seed=SEED, ml_ratings=None), ALSSpec(reg=REG, seed=SEED, implicit=True, ml_ratings=None),
                 ALSSpec(reg=REG, seed=SEED, solver="gram")):
        path = f"{_folder(spark)}/model"
        fitted, loaded = get_model(train, spec, path), get_model(train, spec, path)
        for side in ("userFactors", "itemFactors"):
            other = getattr(loaded, side).select("id", F.col("features").alias("other"))
            row = getattr(fitted, side).join(other, "id", "full").agg(
                F.count("id").alias("n_ids"), F.count(F.when(F.col("features") == F.col("other"), 1)).alias("n_same"))
            row = row.select(F.lit(spec.model_type).alias("model_type"), F.lit(spec.solver).alias("solver"),
                             F.lit(side).alias("side"), "n_ids", "n_same")
            out = row if out is None else out.unionByName(row)
    return out


def q_split_merge(spark, sf):
    """A split of four fifths of the pairs, and the rest merged into it in two
    deltas, the first of them twice, as a retry does."""
    inter, path = _inter(spark, sf), f"{_folder(spark)}/split"
    spec, tenth = PrepareSpec(seed=SEED, low_threshold=LOW, shares=SPARSE), bucket("delta", "user_id", "item_id", modulus=10)
    merge_delta(inter.filter(tenth > 1), path, spec, "base")
    for delta_id, part in (("first", 0), ("second", 1), ("first", 0)):
        merge_delta(inter.filter(tenth == part), path, spec, delta_id)
    return read_split(spark, path)


def q_als_coverage(spark, sf):
    return collect_recs(_als_rows(_splits(spark, sf), False)).select(
        "user_id", F.size("recommendations").alias("n_recs"))


def q_train_eval(spark, sf):
    return _figures(q_train_eval_metrics(spark, sf), "model_type", "rank", "reg", "k")


def q_train_eval_metrics(spark, sf):
    return train_eval(_splits(spark, sf), ALSSpec(reg=REG, seed=SEED), K)


def q_tune_grid(spark, sf):
    return _figures(tune_grid(_splits(spark, sf), k=K, base=GRID_SPEC), "model_type", "rank", "reg", "k")


def q_tune_weight(spark, sf):
    return _figures(q_tune_weight_metrics(spark, sf), "weight", "model_type", "rank", "reg", "k")


def q_tune_weight_metrics(spark, sf):
    return tune_weight(_splits(spark, sf), ALSSpec(reg=REG, seed=SEED), K)


def q_flagship(spark, sf):
    return _figures(q_flagship_metrics(spark, sf), "model", "model_type", "rank", "reg", "k")


def q_flagship_metrics(spark, sf):
    return final_test(_splits(spark, sf), ALSSpec(reg=REG, seed=SEED), K)


# The training-data operators are optional: without their subpackage, and the
# pipeline built from it, every other query works.
try:
    import corpus_pipeline
    from recsift.llm.entry import ORACLE_SQL as _LLM_SQL
    from recsift.llm.entry import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as err:
    if not (err.name or "").startswith(("recsift.llm", "corpus_pipeline")):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL = {**_LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_")
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: final test of the basic and the hybrid model."""
    sf = "/root/testdata/sf0.001"
    splits = _written(prepare(_inter(spark, sf), PrepareSpec(seed=SEED, low_threshold=2)))
    return final_test(splits, ALSSpec(reg=REG, seed=SEED), K)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


# ---------------------------------------------------------------- oracle SQL

def _sql(body: str, **kw) -> str:
    return T.with_ctes(body, **kw)


def _pop(body: str) -> str:
    return f"WITH {T.ctes()}{T.pop_list_ctes(K)}\n{body}"


_LISTS = (f"SELECT DISTINCT user_id, n AS n_items, n AS n_distinct, true AS all_in_train, "
          f"true AS positions_run, true AS scores_fall FROM final, (SELECT least({K}, count(DISTINCT item_id)) AS n "
          f"FROM final WHERE split = 'train') t WHERE split = 'val' "
          f"AND user_id IN (SELECT user_id FROM final WHERE split = 'train')")


def _facts(params: str, split_name: str = "val", trained_on=("train",), rows: str = "") -> str:
    return (f"WITH {T.ctes()}{T.known_users(split_name, trained_on)}\nSELECT {params}, "
            f"{K} AS k, n_users_evaluated, n_users_with_labels, true AS in_range FROM figures{rows}")


def _values(name: str, items) -> str:
    return f", (VALUES {', '.join(f'({x})' for x in items)}) v_{name}({name})"


def _id_map_sql() -> str:
    part = (f"SELECT '{{0}}' AS kind, count(DISTINCT {{0}}) AS n_ids, count(DISTINCT {{0}}) AS n_dense, "
            f"0 AS first, count(DISTINCT {{0}}) - 1 AS last, count(*) AS n_rows, "
            f"CAST(sum({{0}}) AS BIGINT) AS id_sum FROM ({T.INTERACTIONS}) i")
    return "\nUNION ALL\n".join(part.format(c) for c in ("user_id", "item_id"))


def _metric(body: str) -> str:
    preds = "rat_long"
    return f"WITH {T.ctes()}{T.pop_list_ctes(K)}{T.metric_ctes(preds, K)}\n{body}"


def _fractions_sql() -> str:
    parts = []
    for f in FRACTIONS:
        inner = T.with_ctes("SELECT * FROM final", fraction=f, seed=SEED, low=LOW)
        parts.append(f"SELECT CAST({f} AS DOUBLE) AS fraction, split, count(*) AS n_rows, "
                     f"count(DISTINCT user_id) AS n_users FROM ({inner}) x GROUP BY split")
    return "\nUNION ALL\n".join(parts)


def _quality_sql() -> str:
    full = f"({T.INTERACTION_ROWS}) f"
    tri = "user_id, item_id, rating"
    split = {s_: f"(SELECT * FROM final WHERE split = '{s_}') x" for s_ in ("train", "val", "test")}
    dup = "SELECT user_id, item_id FROM {} GROUP BY user_id, item_id HAVING count(*) > 1"
    figures = [
        f"(SELECT count(DISTINCT user_id) FROM {full}) AS full_users",
        "(SELECT count(DISTINCT user_id) FROM kept) AS down_users",
        *[f"(SELECT count(DISTINCT user_id) FROM {split[s_]}) AS {s_}_users" for s_ in split],
        f"(SELECT count(*) FROM {full}) AS full_rows",
        "(SELECT count(*) FROM kept) AS down_rows",
        *[f"(SELECT count(*) FROM {split[s_]}) AS {s_}_rows" for s_ in split],
        "(SELECT count(*) FROM final) AS split_rows",
        f"(SELECT count(*) FROM (SELECT {tri} FROM kept EXCEPT SELECT {tri} FROM final) a) AS missing",
        f"(SELECT count(*) FROM (SELECT {tri} FROM final EXCEPT SELECT {tri} FROM kept) b) AS extra",
        f"(SELECT count(*) FROM ({dup.format(full)}) d) AS full_duplicates",
        f"(SELECT count(*) FROM ({dup.format('kept')}) d) AS down_duplicates",
        f"(SELECT count(*) FROM ({dup.format('final')}) d) AS split_duplicates",
    ]
    share = "round(CAST({} AS DOUBLE) / {}, 9)"
    shares = [f"{share.format('down_users', 'full_users')} AS down_user_share",
              *[f"{share.format(f'{s_}_users', 'down_users')} AS {s_}_user_share" for s_ in split],
              f"{share.format('split_rows', 'down_rows')} AS split_row_share"]
    body = f"SELECT *, {', '.join(shares)} FROM (SELECT {', '.join(figures)}) q"
    return _sql(body, fraction=PREPARE_FRACTION)


def oracle_sql() -> dict[str, str]:
    tri = "user_id, item_id, rating"
    out = {
        "interactions": T.INTERACTIONS,
        "remove_zeros": _sql("SELECT * FROM base"),
        "remove_low_users": _sql(f"SELECT {tri} FROM kept"),
        "downsample_users": _sql(f"SELECT {tri} FROM down", fraction=DOWN_FRACTION),
        "split_users": _sql(f"SELECT {tri}, role FROM roles"),
        "holdout_rows": _sql(f"SELECT {tri}, role FROM tagged WHERE held"),
        "train_rows": _sql(f"SELECT {tri} FROM tagged WHERE NOT held"),
        "putback_users": _sql(f"SELECT {tri}, role FROM moved WHERE put_back AND held", shares=SPARSE),
        "drop_unobserved_items": _sql(
            f"SELECT m.user_id, m.item_id, m.rating, m.split FROM moved m "
            f"JOIN iseen s ON m.item_id = s.item_id WHERE s.seen = 0", shares=SPARSE),
        "splits": _sql(f"SELECT {tri}, is_reviewed, split FROM final"),
        "splits_raw": _sql(f"SELECT {tri}, is_reviewed, split FROM raw"),
        "prepare": _sql(f"SELECT {tri}, is_reviewed, split FROM final", fraction=PREPARE_FRACTION),
        "materialize_roundtrip": _sql(f"SELECT {tri}, is_reviewed, split FROM final"),
        "split_fractions": _fractions_sql(),
        "fraction_splits": _sql(f"SELECT {tri}, is_reviewed, split FROM final",
                                fraction=DOWN_FRACTION),
        "split_report": _sql("SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, "
                             "count(DISTINCT item_id) AS n_items FROM final GROUP BY split"),
        "quality_report": _quality_sql(),
        "conservation": _sql(
            f"(SELECT {tri}, 'missing' AS side FROM (SELECT {tri} FROM kept EXCEPT "
            f"SELECT {tri} FROM final) a) UNION ALL (SELECT {tri}, 'extra' AS side FROM "
            f"(SELECT {tri} FROM final EXCEPT SELECT {tri} FROM kept) b)", shares=SPARSE),
        "duplicate_pairs": f"SELECT user_id, item_id, count(*) AS n FROM ({T.INTERACTION_ROWS}) r "
                           "GROUP BY user_id, item_id HAVING count(*) > 1",
        "train_plus_val": _sql(f"SELECT {tri} FROM final WHERE split IN ('train', 'val')"),
        "review_split": _sql("SELECT user_id, item_id, is_reviewed FROM final WHERE split = 'train'"),
        "eval_users": _sql("SELECT DISTINCT user_id FROM final WHERE split = 'val'"),
        "true_labels": _sql("SELECT DISTINCT user_id, item_id FROM final "
                            "WHERE split = 'val' AND rating > 3"),
        "pred_labels": _pop("SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id FROM rat_long"),
        "explode_recs": _pop("SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id, "
                             "CAST(score AS FLOAT) AS rating FROM rat_long"),
        "map_metric": _metric("SELECT user_id, round(ap, 9) AS ap FROM pu"),
        "ndcg_at_k": _metric("SELECT user_id, round(ndcg, 9) AS ndcg FROM pu"),
        "precision_at_k": _metric("SELECT user_id, round(precision, 9) AS precision FROM pu"),
        "ranking_metrics": _metric(T.metric_summary()),
        "fuse_scores": _pop(f"SELECT user_id, item_id, rat_rating, rev_rating, "
                            f"rev_rating * {FUSE_WEIGHT} + rat_rating AS rating FROM fused"),
        "topk_lists": _pop(
            f"SELECT user_id, CAST(pos AS INTEGER) AS pos, item_id, rating FROM "
            f"(SELECT user_id, item_id, rev_rating * {FUSE_WEIGHT} + rat_rating AS rating, "
            f"row_number() OVER (PARTITION BY user_id ORDER BY rev_rating * {FUSE_WEIGHT} + "
            f"rat_rating DESC, item_id) AS pos FROM fused) t WHERE pos <= {K}"),
        "topk_lists_running": _pop(
            f"SELECT user_id, array_to_string(list_sort(items), ',') AS items FROM "
            f"(SELECT user_id, list(item_id) OVER (PARTITION BY user_id ORDER BY "
            f"rev_rating * {FUSE_WEIGHT} + rat_rating DESC) AS items FROM fused) t "
            f"WHERE len(items) = {K}"),
        "hybrid_topk": (f"WITH {T.ctes()}{T.pop_list_ctes(K)}{T.topk_cte(K, [FUSE_WEIGHT])}"
                        f"{T.metric_ctes('lists', K)}\n{T.metric_summary()}"),
        "tune_weight_lists": (f"WITH {T.ctes()}{T.pop_list_ctes(K)}{T.topk_cte(K, WEIGHTS)}"
                              f"{T.metric_ctes('lists', K, by='weight')}\n"
                              f"{T.metric_summary(by='weight')}"),
        "id_map": _id_map_sql(),
        "als_topk_explicit": _sql(_LISTS),
        "als_topk_implicit": _sql(_LISTS),
        "als_gram_topk_explicit": _sql(_LISTS),
        "als_gram_topk_implicit": _sql(_LISTS),
        "als_gram_parity": _sql(
            "SELECT model_type, side, n AS n_ids, n AS n_close FROM (VALUES ('explicit'), ('implicit')) m(model_type), "
            "(SELECT 'userFactors' AS side, count(DISTINCT user_id) AS n FROM final WHERE split = 'train' UNION ALL "
            "SELECT 'itemFactors', count(DISTINCT item_id) FROM final WHERE split = 'train') t"),
        "recs_roundtrip": _sql(f"SELECT user_id, n_items, n_items AS n_same FROM ({_LISTS}) t"),
        "model_roundtrip": _sql(
            "SELECT model_type, solver, side, n AS n_ids, n AS n_same FROM (VALUES ('explicit', 'ml'), ('implicit', 'ml'), "
            "('explicit', 'gram')) m(model_type, solver), (SELECT 'userFactors' AS side, count(DISTINCT user_id) AS n "
            "FROM final WHERE split = 'train' UNION ALL "
            "SELECT 'itemFactors', count(DISTINCT item_id) FROM final WHERE split = 'train') t"),
        "split_merge": _sql(f"SELECT {tri}, is_reviewed, split FROM final", shares=SPARSE),
        "train_eval": _facts(f"'explicit' AS model_type, 10 AS rank, CAST({REG} AS DOUBLE) AS reg"),
        "tune_grid": _facts("'explicit' AS model_type, rank, CAST(reg AS DOUBLE) AS reg",
                            rows=_values("rank", GRID_RANKS) + _values("reg", GRID_REGS)),
        "tune_weight": _facts(f"CAST(weight AS DOUBLE) AS weight, 'explicit' AS model_type, 10 AS rank, "
                              f"CAST({REG} AS DOUBLE) AS reg", rows=_values("weight", WEIGHTS)),
        "flagship": _facts(f"model, 'explicit' AS model_type, 10 AS rank, CAST({REG} AS DOUBLE) AS reg",
                           "test", ("train", "val"), _values("model", ("'basic'", "'hybrid'"))),
        "label_arrays": _sql(
            f"SELECT user_id, CAST(n // {LABELS_IN_ARRAY} AS INTEGER) AS chunk, string_agg(item_id, ',' ORDER BY item_id) "
            f"AS items FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS n "
            f"FROM (SELECT DISTINCT user_id, item_id FROM final WHERE split = 'val' AND rating > 3) d) x "
            f"GROUP BY user_id, n // {LABELS_IN_ARRAY}"),
        "csv_scan": (
            f"SELECT status, count(*) AS n_rows, CAST(sum(u) AS BIGINT) AS sum_user_id, CAST(sum(i) AS BIGINT) AS "
            f"sum_item_id, CAST(sum(r) AS BIGINT) AS sum_rating FROM (SELECT status, CASE WHEN status = 'kept' THEN user_id "
            f"END AS u, CASE WHEN status = 'kept' THEN item_id END AS i, CASE WHEN status = 'kept' THEN rating END AS r "
            f"FROM (SELECT *, CASE WHEN user_id % 97 = 0 OR item_id % 89 = 0 THEN 'malformed' WHEN item_id % 83 = 0 "
            f"THEN 'no id' ELSE 'kept' END AS status FROM ({T.INTERACTION_ROWS}) t) s) x GROUP BY status"),
        "runs_table": (f"WITH {T.ctes()}{T.pop_list_ctes(K)}{T.topk_cte(K, WEIGHTS)}"
                       f"{T.metric_ctes('lists', K, by='weight')}\n"
                       f"SELECT m.*, run FROM ({T.metric_summary(by='weight')}) m, (VALUES ('first'), ('second')) r(run)"),
        "als_coverage": _sql(
            f"SELECT DISTINCT user_id, CAST(least({K}, (SELECT count(DISTINCT item_id) FROM final "
            f"WHERE split = 'train')) AS INTEGER) AS n_recs FROM final WHERE split = 'val' "
            f"AND user_id IN (SELECT user_id FROM final WHERE split = 'train')"),
    }
    return {**out, **_LLM_SQL}
