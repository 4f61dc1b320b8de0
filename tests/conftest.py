import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recsift.session import local_session

    s = local_session(4, shuffle_partitions=8)
    yield s


def sliding_rows(n_users=10, n_items=13, per_user=4, dense_users=(), dense_items=10,
                 item0=101, seed=7):
    """Own fixture generator: user u rates a window of ``per_user`` consecutive
    items starting at a user-dependent offset; ``dense_users`` rate
    ``dense_items`` items each. Ratings 0..5 from a simple rule."""
    rows = []
    for u in range(1, n_users + 1):
        width = dense_items if u in dense_users else per_user
        start = (u * 3) % n_items
        for j in range(width):
            item = item0 + (start + j) % n_items
            rating = (u * 7 + j * 5 + seed) % 6
            rows.append((u, item, rating, int((u + j) % 4 == 0)))
    return rows
