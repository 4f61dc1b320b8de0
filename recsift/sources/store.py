"""Write-through materialisation and a parameter-keyed artefact store.

Every artefact (interaction table, splits, model, recommendation lists, run
results) lives under the shared checkpoint folder at a path built from *all*
parameters that produced it, including the model type and a fingerprint of the
source. Artefacts that several drivers may write are committed by
:mod:`recsift.sources.commits`. A table or model at a path of its own is complete
once it has the ``_SUCCESS`` marker that Spark's committer writes last (a model:
its three tables); what a lost driver left half-written is computed again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.session import checkpoint_dir


def fingerprint(*parts: object) -> str:
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:12]


def data_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Fingerprint of the data under ``paths`` from file metadata only: total
    bytes, file count and newest modification time of each path, nested
    partitions included (one aggregate over Spark's file listing; no content
    is read). A rewritten or extended input gets a new fingerprint, so stale
    artefacts are never read back."""
    parts = []
    for p in paths:
        if not path_exists(spark, p):
            parts.append(f"{p}:absent")
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
        n, size, newest = files.agg(F.count("path"), F.sum("length"),
                                    F.max(F.unix_micros("modificationTime"))).first()
        parts.append(f"{p}:{size}:{n}:{newest}")
    return fingerprint(*parts)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))  # noqa: SLF001


def source_key(spark: SparkSession, source: str) -> str:
    """``source`` plus the fingerprint of the files an artefact is derived from."""
    from recsift.sources.interactions import source_paths

    return f"{source}|{data_fingerprint(spark, *source_paths(spark, source))}"


# Bumped whenever the rows an artefact holds would change for the same
# parameters (a change of split, mapping or scoring rule), so that tables
# written by an older version are never read back.
ARTEFACT_VERSION = 4


def artefact_path(spark: SparkSession, kind: str, source: str, **params: object) -> str:
    """``<checkpoint dir>/recsift/<kind>/<k=v,...>-<fingerprint of source>``
    (the parameters include the artefact format version)."""
    params = {"v": ARTEFACT_VERSION, **params}
    keyed = ",".join(f"{k}={params[k]}" for k in sorted(params))
    return f"{checkpoint_dir(spark)}/recsift/{kind}/{keyed}-{fingerprint(source, keyed)}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete table is at ``path`` (its job was committed)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def materialize(df: DataFrame, path: str, sort_by: tuple[str, ...] = ("user_id", "item_id"),
                partition_by: str | None = None) -> DataFrame:
    """Return the table at ``path`` if present, else write ``df`` there and read it back.

    Rows are range-partitioned and sorted on ``sort_by`` so row-group min/max
    statistics let later filters on the leading key skip data. Ranging on the
    full key (not the user alone) splits a very active user across several
    files; ``sort_by=()`` writes the partitions as they are. Never overwrites a
    complete table; an unfinished one is replaced.
    Reading back cuts the lineage, so lost executors re-read files instead of
    recomputing the whole plan.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
    return spark.read.parquet(path)


def append_runs(df: DataFrame, path: str) -> None:
    """Result sink: append run rows (parameters + metrics) to a Parquet table."""
    df.coalesce(1).write.mode("append").parquet(path)


def commit_runs(df: DataFrame, path: str, run_id: str) -> None:
    """Result sink that a retried run may call again: the rows of ``run_id`` are
    a folder of their own in the runs table at ``path``, there as a whole or not at
    all. A committed run is left as it is; what a lost driver left is replaced."""
    if not re.fullmatch(r"[A-Za-z0-9._+-]+", run_id):
        raise ValueError("a run id has letters, digits and ._+- only")
    folder = f"{path}/run={run_id}"
    if not table_exists(df.sparkSession, folder):
        df.coalesce(1).write.mode("overwrite").parquet(folder)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The committed runs at ``path``, with their ``run`` ids."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)  # noqa: SLF001
    folders = [f.getPath().getParent().toString() for f in found or ()]
    if not folders:
        raise FileNotFoundError(f"no committed run at {path}")
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders) \
        .withColumn("run", F.col("run").cast("string"))


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete ALS model is at ``path``: its metadata and both factor tables."""
    return all(table_exists(spark, f"{path}/{part}") for part in ("metadata", "userFactors", "itemFactors"))


def fit_or_load_als(estimator, train: DataFrame, path: str | None):
    """Fit an ALS estimator, or load the model saved at ``path`` by an earlier fit."""
    from pyspark.ml.recommendation import ALSModel

    if path is None:
        return estimator.fit(train)
    if not model_exists(train.sparkSession, path):
        estimator.fit(train).write().overwrite().save(path)
    return ALSModel.load(path)


def fit_or_load_factors(fit: Callable, spark: SparkSession, rank: int, path: str | None):
    """A :class:`~recsift.operators.gram_als.FactorModel`: ``fit()``, or the two
    factor tables saved at ``path`` by an earlier fit. The items' table is
    written last and is the mark that the model is there."""
    from recsift.operators.gram_als import FactorModel

    if path is None:
        return fit()
    tables = [f"{path}/userFactors", f"{path}/itemFactors"]
    if all(table_exists(spark, t) for t in tables):
        return FactorModel(rank, *map(spark.read.parquet, tables))
    model = fit()
    return FactorModel(rank, *(materialize(df, t, sort_by=("id",)) for df, t in
                               zip((model.userFactors, model.itemFactors), tables, strict=True)))
