"""DataFrame -> DataFrame operators."""

from recsift.operators.filters import relevant, remove_low_users, remove_zeros, user_counts
from recsift.operators.hybrid import (
    fuse_scores,
    hybrid_lists,
    review_split,
    topk_lists,
    topk_lists_running,
    weigh,
)
from recsift.operators.joins import attach_keys, bounded, keep_keys
from recsift.operators.metrics import (
    eval_users,
    label_arrays,
    per_user_metrics,
    ranking_metrics,
    true_labels,
)
from recsift.operators.quality import conservation, duplicate_pairs, quality_report, split_report
from recsift.operators.recs import (
    ALSSpec,
    collect_recs,
    explode_recs,
    fit_als,
    popularity_long,
    popularity_recs,
    pred_labels,
    recommend,
    recommend_long,
)
from recsift.operators.sampling import downsample_users
from recsift.operators.splits import (
    TEST,
    TRAIN,
    VAL,
    SplitSpec,
    assign_roles,
    drop_unobserved_items,
    item_visibility,
    item_visibility_rows,
    put_back,
    split,
    split_view,
    tag_holdout,
    train_rows,
    unseen_users,
)

__all__ = [n for n in dir() if not n.startswith("_")]
