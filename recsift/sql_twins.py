"""DuckDB SQL twins of the registered queries.

Each function returns plain SQL over the driver's views (``lineitem``,
``orders``) that computes, independently of Spark, what the matching query in
``__spark_entry__`` computes. The hash bucket is the same md5 expression in
both engines (see :mod:`recsift.functions.hashing`).
"""

from __future__ import annotations

from recsift.functions.hashing import bucket_sql
from recsift.operators.sampling import DOWNSAMPLE_MODULUS
from recsift.operators.splits import SplitSpec

INTERACTION_ROWS = """
SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
       CAST(l_linestatus = 'F' AS INTEGER) AS is_read,
       CAST(floor(l_quantity / 10) AS INTEGER) AS rating,
       CAST(l_returnflag = 'R' AS INTEGER) AS is_reviewed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

INTERACTIONS = f"""
SELECT user_id, item_id, max(is_read) AS is_read, max(rating) AS rating,
       max(is_reviewed) AS is_reviewed
FROM ({INTERACTION_ROWS}) r GROUP BY user_id, item_id"""


def ctes(fraction: float = 1.0, low: int = 10, seed: int = 42, rm_zeros: bool = True,
         shares: SplitSpec | None = None) -> str:
    """CTE chain: base, down, kept, roles, tagged, useen, moved, iseen, final, raw."""
    shares = shares or SplitSpec(seed=seed)
    val_end = shares.train_share + shares.val_share
    where = "WHERE rating > 0" if rm_zeros else ""
    cut = int(round(fraction * DOWNSAMPLE_MODULUS))
    down = ("SELECT * FROM base" if fraction == 1 else
            f"SELECT * FROM base WHERE {bucket_sql(f'{seed}d', 'user_id', modulus=DOWNSAMPLE_MODULUS)} < {cut}")
    kept = ("SELECT * FROM down" if low == 0 else
            f"SELECT * FROM down WHERE user_id IN "
            f"(SELECT user_id FROM down GROUP BY user_id HAVING count(*) > {low})")
    bs = bucket_sql(f"{seed}s", "user_id")
    bh = bucket_sql(f"{seed}h", "user_id", "item_id")
    return f"""
base AS (SELECT * FROM ({INTERACTIONS}) i {where}),
down AS ({down}),
kept AS ({kept}),
roles AS (SELECT kept.*, CASE WHEN {bs} < {shares.train_share} THEN 'train' WHEN {bs} < {val_end} THEN 'val'
                              ELSE 'test' END AS role FROM kept),
tagged AS (SELECT roles.*, (role <> 'train' AND {bh} < {shares.holdout}) AS held FROM roles),
useen AS (SELECT user_id, max(CASE WHEN held THEN 0 ELSE 1 END) AS seen
          FROM tagged GROUP BY user_id),
moved AS (SELECT t.*, (u.seen = 0) AS put_back,
                 CASE WHEN NOT t.held OR u.seen = 0 THEN 'train' ELSE t.role END AS split
          FROM tagged t JOIN useen u ON t.user_id = u.user_id),
iseen AS (SELECT item_id, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS seen
          FROM moved GROUP BY item_id),
final AS (SELECT m.* FROM moved m JOIN iseen s ON m.item_id = s.item_id WHERE s.seen = 1),
raw AS (SELECT tagged.*, CASE WHEN held THEN role ELSE 'train' END AS split FROM tagged)"""


def with_ctes(body: str, **kw) -> str:
    return f"WITH {ctes(**kw)}\n{body}"


def pop_list_ctes(k: int, cohorts: int = 8) -> str:
    """Popularity lists for val users, by cohort of users: rating list (row
    count) and review list (review count) of train items, ties to the lower
    id, and their fusion."""
    cohort = bucket_sql("cohort", "user_id", modulus=cohorts)
    s = f""",
eu AS (SELECT DISTINCT user_id FROM final WHERE split = 'val'),
labels AS (SELECT DISTINCT user_id, item_id FROM final WHERE split = 'val' AND rating > 3),
tr AS (SELECT {cohort} AS cohort, item_id, is_reviewed FROM final WHERE split = 'train'),
euc AS (SELECT user_id, {cohort} AS cohort FROM eu),
rat_top AS (SELECT cohort, item_id, CAST(count(*) AS DOUBLE) AS score,
                   row_number() OVER (PARTITION BY cohort ORDER BY count(*) DESC, item_id) AS pos
            FROM tr GROUP BY cohort, item_id QUALIFY pos <= {k}),
rev_top AS (SELECT cohort, item_id, CAST(sum(is_reviewed) AS DOUBLE) AS score,
                   row_number() OVER (PARTITION BY cohort ORDER BY sum(is_reviewed) DESC, item_id) AS pos
            FROM tr GROUP BY cohort, item_id QUALIFY pos <= {k}),
rat_long AS (SELECT e.user_id, r.pos, r.item_id, r.score FROM euc e JOIN rat_top r ON e.cohort = r.cohort),
rev_long AS (SELECT e.user_id, r.pos, r.item_id, r.score FROM euc e JOIN rev_top r ON e.cohort = r.cohort),
fused AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.item_id, b.item_id) AS item_id,
                 coalesce(a.score, 0.0) AS rat_rating, coalesce(b.score, 0.0) AS rev_rating
          FROM rat_long a FULL OUTER JOIN rev_long b
            ON a.user_id = b.user_id AND a.item_id = b.item_id)"""
    return s


def metric_ctes(preds: str, k: int, by: str = "") -> str:
    """Per-user metrics of ``preds(<by>, user_id, pos, item_id)`` against ``labels``."""
    byc = f"{by}, " if by else ""
    pby = ", ".join(f"p.{c.strip()}" for c in by.split(",")) + ", " if by else ""
    return f""",
nlab AS (SELECT user_id, count(*) AS n_labels FROM labels GROUP BY user_id),
flag AS (SELECT {pby}p.user_id, p.pos, (l.item_id IS NOT NULL) AS hit
         FROM {preds} p LEFT JOIN labels l ON p.user_id = l.user_id AND p.item_id = l.item_id),
run AS (SELECT {byc}user_id, pos, hit,
               sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY {byc}user_id ORDER BY pos) AS cum
        FROM flag),
pu AS (SELECT {byc}r.user_id, count(*) AS n_pred, n.n_labels,
              sum(CASE WHEN hit THEN cum / pos ELSE 0 END) / n.n_labels AS ap,
              sum(CASE WHEN hit AND pos <= {k} THEN 1.0 / ln(pos + 1) ELSE 0 END) /
                (SELECT sum(1.0 / ln(i + 1)) FROM range(1, least(n.n_labels, {k}) + 1) t(i)) AS ndcg,
              sum(CASE WHEN hit AND pos <= {k} THEN 1 ELSE 0 END) / CAST({k} AS DOUBLE) AS precision
       FROM run r JOIN nlab n ON r.user_id = n.user_id
       GROUP BY {byc}r.user_id, n.n_labels)"""


def metric_summary(by: str = "") -> str:
    byc = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {byc}round(avg(ap), 9) AS map, round(avg(ndcg), 9) AS ndcg_at_k,
       round(avg(precision), 9) AS precision_at_k, count(*) AS n_users_evaluated,
       (SELECT count(DISTINCT user_id) FROM labels) AS n_users_with_labels
FROM pu {group}"""


def topk_cte(k: int, weights: list[float]) -> str:
    vals = ", ".join(f"(CAST({w} AS DOUBLE))" for w in weights)
    return f""",
ws AS (SELECT * FROM (VALUES {vals}) v(weight)),
scored AS (SELECT ws.weight, f.user_id, f.item_id, f.rev_rating * ws.weight + f.rat_rating AS rating
           FROM fused f CROSS JOIN ws),
lists AS (SELECT weight, user_id, item_id, rating,
                 row_number() OVER (PARTITION BY weight, user_id ORDER BY rating DESC, item_id) AS pos
          FROM scored QUALIFY pos <= {k})"""


def known_users(split: str, trained_on: tuple[str, ...] = ("train",)) -> str:
    """Users with a relevant item in ``split`` (labelled), and of these the
    ones that a model trained on ``trained_on`` knows (evaluated)."""
    seen = ", ".join(f"'{s}'" for s in trained_on)
    return f""",
lab AS (SELECT DISTINCT user_id FROM final WHERE split = '{split}' AND rating > 3),
known AS (SELECT DISTINCT user_id FROM final WHERE split IN ({seen})),
figures AS (SELECT (SELECT count(*) FROM lab WHERE user_id IN (SELECT user_id FROM known)) AS n_users_evaluated,
                   (SELECT count(*) FROM lab) AS n_users_with_labels)"""
