"""Dense ids for users and items beyond an int, through the whole model."""

from pyspark.sql import functions as F

from recsift.operators import ALSSpec, fit_als, recommend_long
from recsift.plans import PrepareSpec, prepare
from recsift.sources import decode_ids, encode_ids, id_map

BIG = 15_000_000_000


def test_map_is_dense_one_to_one_and_ascending(spark):
    df = spark.createDataFrame([(BIG + 7 * i,) for i in range(500)] * 2 + [(None,)], "user_id bigint") \
        .repartition(7)
    rows = id_map(df, "user_id").orderBy("id").collect()
    assert [(r.id, r.dense) for r in rows] == [(BIG + 7 * i, i) for i in range(500)]


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "item_id string")
    assert {r.id: r.dense for r in id_map(df, "item_id").collect()} == {"a": 0, "b": 1, "c": 2}
    assert id_map(df.limit(0), "item_id").count() == 0


def test_large_ids_through_prepare_fit_and_recommend(spark):
    rows = [(BIG + u, f"item-{i:03d}", 1, (u * 7 + i * 3) % 5 + 1, (u + i) % 2)
            for u in range(60) for i in range(u % 4, 40, 2)]
    raw = spark.createDataFrame(rows, "user_id bigint, item_id string, is_read int, rating int, is_reviewed int")
    users, items = id_map(raw, "user_id"), id_map(raw, "item_id")
    encoded = encode_ids(encode_ids(raw, users, "user_id"), items, "item_id")
    assert dict(encoded.dtypes)["user_id"] == dict(encoded.dtypes)["item_id"] == "int"
    s = prepare(encoded, PrepareSpec(low_threshold=2))
    train = s.filter(F.col("split") == "train")
    top = recommend_long(fit_als(train, ALSSpec(rank=3, max_iter=2)), train.select("user_id"), 4)
    back = decode_ids(decode_ids(top, users, "user_id"), items, "item_id").collect()
    assert {r.user_id for r in back} <= {BIG + u for u in range(60)} and back
    assert all(r.item_id.startswith("item-") for r in back)
    assert sorted(map(tuple, decode_ids(decode_ids(encoded, users, "user_id"), items, "item_id").collect())) \
        == sorted(rows)
