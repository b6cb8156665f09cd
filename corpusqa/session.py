"""Spark session helpers.

On a cluster the session is created by the platform; ``get_spark`` only
fills in settings that are unset, so that local runs and tests get sane
defaults while cluster settings win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "corpusqa", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present. Only a session whose
    tasks all run in this process (``local[...]``, as in tests) gets a fresh
    folder under the system temp dir; on a cluster, where executors do not see
    such a folder, an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        d = tempfile.mkdtemp(prefix="corpusqa-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def target_partitions(spark: SparkSession) -> int:
    """Partitions for CPU-heavy per-row stages: the shuffle partition count,
    at least the cluster's default parallelism."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, spark.sparkContext.defaultParallelism)


def spread(df, min_partitions: int | None = None):
    """Give a scan enough partitions for CPU-heavy per-row work.

    A large input already arrives in many splits and is returned unchanged
    (no shuffle). Only a scan with fewer partitions than the cluster can run
    at once -- e.g. one small file with a single row group -- is spread
    round-robin.
    """
    spark = df.sparkSession
    want = min_partitions or target_partitions(spark)
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as Parquet below the shared checkpoint
    folder and reading it back. Used for tables that several later steps
    read (e.g. the feature table read by sampling and its statistics), so
    they are computed once and survive executor loss. The shuffle files of
    the write go with its end: the table stands in for them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.parquet(path)
    out.scratch_path = path
    return out


def release(*tables) -> None:
    """Delete tables that ``materialize`` wrote and that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
