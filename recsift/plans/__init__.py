"""Compositions of operators: preparation, tuning, final test."""

from recsift.plans.merge import merge_delta, read_split
from recsift.plans.prepare import (
    PrepareSpec,
    at_fraction,
    fraction_table,
    prepare,
    prepare_stepwise,
    prepared_table,
    save_fraction_splits,
    split_fractions,
)
from recsift.plans.recs_store import get_model, get_recs, get_recs_long
from recsift.plans.tuning import final_test, train_eval, tune_grid, tune_weight

__all__ = ["PrepareSpec", "at_fraction", "fraction_table", "save_fraction_splits", "prepare", "prepare_stepwise", "prepared_table", "split_fractions",
           "get_recs", "get_recs_long", "final_test", "train_eval", "tune_grid", "tune_weight",
           "merge_delta", "read_split", "get_model"]
