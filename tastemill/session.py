"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tastemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were planned for.

    ``conf`` keys use ``__`` for the dots of a Spark property name.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A sweep runs more distinct plans than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; a cluster
    without the setting is an error, not a silent write to one node's disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="tastemill-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one run under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a place to cut lineage, keeping one already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
