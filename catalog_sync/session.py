"""Session helpers: a tuned local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "catalog_sync") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no per-call Python call-site capture (several JVM round trips per DataFrame/Column call)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` points at shared storage and is used as is. Where
    it is unset this raises: a folder of one machine is of no use to the
    others. Only a single-process session (``local[...]``, as in tests and the
    bench) gets a scratch folder of its own.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="catalog-sync-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables.

    It is deleted by :func:`release_scratch`, at the latest when the driver's Python ends.
    """
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append((spark, path))
    return path


def release_scratch() -> None:
    """Delete all scratch folders so far; the results that read them must have been used."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is not None:  # else the session has ended before
            release(spark, path)


atexit.register(release_scratch)


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder
    and reading it back; returns the copy and its path (see :func:`release`).

    One job computes and writes the plan (a reliable ``checkpoint()`` runs it
    twice unless cached, and stores Java-serialized rows); the copy is
    columnar, survives lost executors, and later stages get real file
    statistics for join planning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a copy made by :func:`materialize_at` once nothing reads it any more,
    so a recurring job does not pile up copies in the shared folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
