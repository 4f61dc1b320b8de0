"""Row identity for operators whose rows meet again after a shuffle.

A row is named by ``(_k, _sub)``: ``_k`` is its id (null: the largest long)
and ``_sub`` is 0 unless several rows share that id; then it is 60 bits of the
text's SHA-256. Rows with the same id and the same text have one name and get
one result, given to each. Where whole rows are returned, ``_row`` tells rows of
one name apart that differ in other columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.session import checkpoint_dir

NULL_KEY = (1 << 63) - 1


def saved(df: DataFrame) -> DataFrame:
    """Written once to the shared checkpoint folder and read from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def name_columns(id_col: str, text_col: str) -> tuple[Column, Column]:
    """``_k`` and, where ids repeat, ``_sub`` of a row, as ``_id_key`` and ``_digest``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("_id_key"),
            F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long").alias("_digest"))


def _repeated_ids(rows: DataFrame) -> DataFrame | None:
    """Ids (``_id_key``) of several rows; None if there are none. Only ids are shuffled."""
    repeated = saved(rows.groupBy("_id_key").count().filter("count > 1").select("_id_key"))
    return None if repeated.isEmpty() else repeated


def keyed(docs: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``(_k, _sub, text)``, each name once, and a function that gives a result
    by ``(_k, _sub)`` to every row of ``docs``.

    Ids are counted first. When none repeats, the names are read off the rows
    and the function changes nothing; else the rows of repeated ids are told
    apart by digest and equal ones merged.
    """
    rows = docs.select(*name_columns(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    repeated = _repeated_ids(rows)
    key = F.col("_id_key").alias("_k")
    if repeated is None:
        return rows.select(key, F.lit(0).cast("long").alias("_sub"), "text"), lambda result: result
    alone = rows.join(repeated, "_id_key", "left_anti").select(key, F.lit(0).cast("long").alias("_sub"), "text")
    twice = saved(rows.join(repeated, "_id_key", "left_semi").select(key, F.col("_digest").alias("_sub"), "text"))
    names = alone.select("_k", "_sub").unionByName(twice.select("_k", "_sub"))
    once = twice.groupBy("_k", "_sub").agg(F.first("text").alias("text"))
    return alone.unionByName(once), lambda result: names.join(result, ["_k", "_sub"])


def row_hash(df: DataFrame) -> Column:
    """64 bits of all columns, nulls included; equal rows have equal ones."""
    parts = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        flat = field.dataType.simpleString()
        # no hash of maps and variants
        parts += [F.to_json(F.struct(value)) if "map<" in flat or "variant" in flat else value, value.isNull()]
    return F.xxhash64(*parts)


def packed_once(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``(_id_key, _digest, _row, row)``, equal rows once, and the name of the
    row's column, a struct of all columns. ``_row`` is :func:`row_hash`."""
    row = "".join(docs.columns) + "_"  # a name that no column has
    packed = docs.select(F.struct("*").alias(row), *name_columns(id_col, text_col), row_hash(docs).alias("_row"))
    if _repeated_ids(packed) is not None:
        packed = packed.groupBy("_id_key", "_digest", "_row").agg(F.first(row).alias(row))
    return packed, row


def id_of(key: str = "_k"):
    """The id behind ``_k``: null for the null key."""
    return F.when(F.col(key) != NULL_KEY, F.col(key))
