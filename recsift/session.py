"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder that lineage cuts are written to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_registered: dict[int, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "recsift", driver_memory: str = "16g") -> SparkSession:
    """A local session configured the way the library expects (AQE on, UI off).

    Only for tests, benches and the driver smoke check; on a cluster build the
    session with ``spark-submit`` and its own defaults.
    """
    parts = shuffle_partitions or (2 * os.cpu_count() if cores == "*" else 2 * int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without the
    setting gets a fresh folder of its own; a cluster session without it is an
    error, since a machine-local folder would not be shared by executors.
    """
    sc = spark.sparkContext
    path = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="recsift-ckpt-", dir="/tmp")
        spark.conf.set(_CKPT_KEY, path)
    if _registered.get(id(sc)) != path:
        sc.setCheckpointDir(path)
        _registered[id(sc)] = path
    return path.rstrip("/")
