"""Interaction tables.

The interaction table is one row per (user, item) with the columns
``user_id, item_id, is_read, rating, is_reviewed`` (all int). ``rating`` is
0..5 where 0 is a placeholder for "not rated".

A *source* is a path of one of three kinds (see :func:`source_kind`): a folder
of the driver tables, a raw interactions CSV export, or an interactions
Parquet table. Every source goes through the same one-row-per-pair rule.

On the TPC-H-like driver tables the mapping is: a customer is a user, a part is
an item, the order line quantity gives the rating, the return flag the review
flag and the line status the read flag. Several lines can share a
(customer, part) pair, so the rows are grouped on the pair and each column
takes its maximum.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INTERACTION_COLUMNS = ["user_id", "item_id", "is_read", "rating", "is_reviewed"]

# Fixed schemas of the raw CSV exports: interactions plus the two id maps.
CSV_SCHEMAS = {
    "interactions": "user_id INT, item_id INT, is_read INT, rating INT, is_reviewed INT",
    "users": "user_id_csv INT, user_id STRING",
    "items": "item_id_csv INT, item_id STRING",
}


def source_kind(spark: SparkSession, source: str) -> str:
    """``'csv'`` for a path ending in ``.csv`` (a file or a folder of parts),
    ``'tables'`` for a folder holding ``lineitem.parquet``, else ``'parquet'``
    (an interactions table with :data:`INTERACTION_COLUMNS`)."""
    from recsift.sources.store import path_exists

    if source.rstrip("/").endswith(".csv"):
        return "csv"
    if path_exists(spark, f"{source.rstrip('/')}/lineitem.parquet"):
        return "tables"
    return "parquet"


def source_paths(spark: SparkSession, source: str) -> list[str]:
    """The files a source's interactions are derived from (for fingerprints)."""
    if source_kind(spark, source) == "tables":
        return [f"{source.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")]
    return [source]


def interaction_rows(spark: SparkSession, source: str) -> DataFrame:
    """Interaction rows before the one-row-per-pair rule (may repeat pairs);
    rows with a null user or item id are dropped here, once.

    For the driver tables these are the mapped order lines. Ids must fit an
    int, as the model needs; larger or textual ids go through
    :mod:`recsift.sources.id_map` first."""
    return _source_rows(spark, source).filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())


def _source_rows(spark: SparkSession, source: str) -> DataFrame:
    kind = source_kind(spark, source)
    if kind == "csv":
        return read_csv_table(spark, source).select(*INTERACTION_COLUMNS)
    if kind == "parquet":
        return spark.read.parquet(source).select(
            *[F.col(c).cast("int").alias(c) for c in INTERACTION_COLUMNS])
    sf_dir = source
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_read"),
        F.floor(F.col("l_quantity") / 10).cast("int").alias("rating"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_reviewed"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, item), each column its maximum over repeated rows.
    The grouping runs a partial aggregate before its shuffle; the shuffle is
    on both keys, so a very active user is spread over many tasks."""
    return one_row_per_pair(interaction_rows(spark, sf_dir))


def one_row_per_pair(rows: DataFrame) -> DataFrame:
    """The one-row-per-pair rule over :func:`interaction_rows`."""
    return rows.groupBy("user_id", "item_id").agg(
        F.max("is_read").alias("is_read"),
        F.max("rating").alias("rating"),
        F.max("is_reviewed").alias("is_reviewed"),
    )


def read_csv_table(spark: SparkSession, path: str, which: str = "interactions") -> DataFrame:
    """Raw CSV export with a header and a fixed schema (no inference pass)."""
    if which not in CSV_SCHEMAS:
        raise ValueError(f"unknown table {which!r}; expected one of {sorted(CSV_SCHEMAS)}")
    return spark.read.csv(path, header=True, schema=CSV_SCHEMAS[which])


@dataclass(frozen=True)
class CsvScan:
    """A CSV export as read once: ``rows`` with the declared columns,
    ``rejected`` ``(file, record, reason)``, every other record, and ``n_read``
    records in all."""

    rows: DataFrame
    rejected: DataFrame
    n_read: int

    def balance(self) -> DataFrame:
        """``(status, n_rows)``: kept rows, and rejected ones by reason. They add up to ``n_read``."""
        kept = self.rows.agg(F.lit("kept").alias("status"), F.count(F.lit(1)).alias("n_rows"))
        gone = self.rejected.groupBy(F.col("reason").alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))
        return kept.unionByName(gone)


def scan_csv(spark: SparkSession, path: str, which: str = "interactions",
             required: tuple[str, ...] | None = None) -> CsvScan:
    """Reads a raw CSV export (header, fixed schema) without losing a record.

    A record with a value that its column's type does not hold (text in a number, a
    number beyond int) or with too many or too few fields is rejected as
    ``malformed``; one without a value in a ``required`` column (by default the
    interactions' ids, else the first column) as ``no id``. All others are
    kept. The parsed records are written once to the shared folder, which both
    tables read, so they come from one reading of the export.
    """
    from recsift.operators.joins import materialize_keys

    if which not in CSV_SCHEMAS:
        raise ValueError(f"unknown table {which!r}; expected one of {sorted(CSV_SCHEMAS)}")
    schema = CSV_SCHEMAS[which]
    columns = [c.split()[0] for c in schema.split(", ")]
    if required is None:
        required = ("user_id", "item_id") if which == "interactions" else tuple(columns[:1])
    # all columns are parsed, whatever a query needs: a bad value counts wherever it is
    read = spark.read.csv(path, header=True, schema=f"{schema}, _record STRING", mode="PERMISSIVE",
                          columnNameOfCorruptRecord="_record", enforceSchema=True)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    told = F.when(F.col("_record").isNotNull(), "malformed").when(missing, "no id")
    parsed = materialize_keys(read.select(*columns, "_record", F.col("_metadata.file_path").alias("file"))
                              .withColumn("reason", told))
    as_text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    rejected = parsed.filter("reason is not null").select("file", F.coalesce("_record", as_text).alias("record"), "reason")
    return CsvScan(parsed.filter("reason is null").select(*columns), rejected, parsed.count())


def interactions_table(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """The interaction table written once under the shared checkpoint folder.

    Building it joins the two largest tables and groups the result, and
    preparation reads it several times (size checks, per-user and per-item
    aggregates, the final rows), so it is materialised instead of recomputed.
    The write keeps the aggregate's hash layout (no extra sort); ``root``
    overrides the folder (a fresh one per benchmark run).
    """
    from recsift.sources.commits import load_or_compute
    from recsift.sources.store import artefact_path, materialize, source_key

    if root:  # one writer, so no commit is needed
        return materialize(interactions(spark, sf_dir), f"{root}/interactions", sort_by=())
    path = artefact_path(spark, "interactions", source_key(spark, sf_dir), schema="v1")
    return load_or_compute(spark, path, lambda: interactions(spark, sf_dir), sort_by=())
