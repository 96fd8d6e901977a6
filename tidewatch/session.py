"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and switches a join to broadcast only after measuring the side.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # Recording the Python call site of every column slows plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Event times are UTC; pin the session zone before a plan is built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Clusters name it in ``spark.checkpoint.dir``. Only where that is unset
    (local tests) a temporary folder is made and recorded in the session.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a fresh table in the shared folder: computed once, and its lineage cut."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
