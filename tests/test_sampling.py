import duckdb
import pytest
from pyspark.sql import functions as F

from recsift.functions.hashing import bucket, bucket_sql
from recsift.operators import downsample_users
from recsift.operators.sampling import check_fraction


def test_bucket_matches_duckdb(spark):
    ids = spark.range(0, 3000).select(F.col("id").cast("int").alias("user_id"),
                                      (F.col("id") * 7 % 101).cast("int").alias("item_id"))
    got = {(r.user_id, r.b1, r.b2) for r in ids.select(
        "user_id", bucket("42s", "user_id").alias("b1"),
        bucket("x", "user_id", "item_id", modulus=10_000).alias("b2")).collect()}
    con = duckdb.connect()
    want = set(con.sql(
        f"SELECT CAST(i AS INTEGER) AS user_id, {bucket_sql('42s', 'user_id')} AS b1, "
        f"{bucket_sql('x', 'user_id', 'item_id', modulus=10_000)} AS b2 FROM "
        f"(SELECT i, CAST(i AS INTEGER) AS user_id, CAST(i * 7 % 101 AS INTEGER) AS item_id "
        f"FROM range(0, 3000) t(i))").fetchall())
    assert got == want


def test_bucket_share_close_to_fraction(spark):
    users = spark.range(0, 20000).select(F.col("id").cast("int").alias("user_id"))
    share = users.filter(bucket("42s", "user_id") < 600).count() / 20000
    assert abs(share - 0.6) < 0.02


def test_downsample_keeps_whole_users_and_nests(spark):
    rows = [(u, i, 1) for u in range(200) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating int")
    small = downsample_users(df, 0.1)
    big = downsample_users(df, 0.4)
    per_user = {r.user_id: r.n for r in small.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert per_user and set(per_user.values()) == {5}
    assert set(per_user) <= {r.user_id for r in big.select("user_id").distinct().collect()}
    assert downsample_users(df, 1.0) is df


def test_downsample_independent_of_layout(spark):
    rows = [(u, i, 1) for u in range(300) for i in range(3)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating int")
    a = downsample_users(df.repartition(2), 0.3).collect()
    b = downsample_users(df.repartition(7), 0.3).collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("bad", [0, -0.1, 1.5, 0.00001])
def test_fraction_rejected(bad):
    with pytest.raises(ValueError):
        check_fraction(bad)
