"""Properties of the preparation on random tables (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recsift.plans import PrepareSpec, prepare, prepare_stepwise

SCHEMA = "user_id int, item_id int, is_read int, rating int, is_reviewed int"

tables = st.lists(
    st.tuples(st.integers(1, 25), st.integers(1, 20), st.integers(0, 5), st.integers(0, 1)),
    min_size=0, max_size=160,
).map(lambda rows: sorted({(u, i): (u, i, 1, r, v) for u, i, r, v in rows}.values()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=tables, seed=st.integers(0, 99), low=st.sampled_from([0, 1, 3, 6]),
       fraction=st.sampled_from([0.3, 0.7, 1.0]), parts=st.integers(1, 5))
def test_fused_equals_stepwise_and_invariants(spark, rows, seed, low, fraction, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    spec = PrepareSpec(fraction=fraction, seed=seed, low_threshold=low)
    got = sorted(map(tuple, prepare(df, spec).collect()))
    assert got == sorted(map(tuple, prepare_stepwise(df, spec).collect()))
    assert len({(r[0], r[1]) for r in got}) == len(got)                # one row per pair
    train = [r for r in got if r[4] == "train"]
    held = [r for r in got if r[4] != "train"]
    assert {r[0] for r in held} <= {r[0] for r in train}                 # no unseen user
    assert {r[1] for r in held} <= {r[1] for r in train}                 # no unseen item
    assert not {r[0] for r in got if r[4] == "val"} & {r[0] for r in got if r[4] == "test"}
    assert all(r[2] > 0 for r in got)                                    # zeros removed
    counts = {}
    for u, _i, _read, r, _v in rows:
        if r > 0:
            counts[u] = counts.get(u, 0) + 1
    assert all(counts[r[0]] > low for r in got)                          # low users removed
