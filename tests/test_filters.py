import pytest

from conftest import sliding_rows
from recsift.operators import remove_low_users, remove_zeros
from recsift.operators.filters import check_threshold

SCHEMA = "user_id int, item_id int, rating int, is_reviewed int"


def test_remove_zeros_and_nulls(spark):
    rows = sliding_rows() + [(99, 1, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sum(1 for r in rows if r[2] is not None and r[2] > 0)
    assert remove_zeros(df).count() == want


@pytest.mark.parametrize("threshold", [0, 3, 4, 9, 10])
def test_remove_low_users_strict(spark, threshold):
    rows = sliding_rows(n_users=40, n_items=39, dense_users=range(10, 30))
    df = remove_zeros(spark.createDataFrame(rows, SCHEMA))
    kept = remove_low_users(df, threshold)
    nz = [r for r in rows if r[2] > 0]
    counts = {}
    for r in nz:
        counts[r[0]] = counts.get(r[0], 0) + 1
    want = [r for r in nz if threshold == 0 or counts[r[0]] > threshold]
    assert sorted(tuple(r) for r in kept.collect()) == sorted(want)


def test_remove_low_users_both_join_sides(spark):
    """The filter picks the smaller of kept / dropped users; force both paths."""
    rows = sliding_rows(n_users=40, n_items=39, dense_users=range(10, 30))
    df = spark.createDataFrame(rows, SCHEMA)
    few_kept = remove_low_users(df, 9).count()      # most users dropped -> semi join
    many_kept = remove_low_users(df, 3).count()     # few users dropped -> anti join
    assert few_kept == sum(1 for r in rows if r[0] in range(10, 30))
    assert many_kept == len(rows)


@pytest.mark.parametrize("bad", [-1, 1.5, True, "3"])
def test_threshold_validated(bad):
    with pytest.raises(ValueError):
        check_threshold(bad)
