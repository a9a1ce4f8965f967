"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "metricwatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small local inputs: keep several partitions per stage instead of merging to a few
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("METRICWATCH_DRIVER_MEMORY", "8g"))
    )
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session leaves it unset (tests, local runs) is ``fallback``
    installed; on a cluster the configured shared folder is always used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is unset; pass a shared folder as fallback")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def warehouse_checkpoints(spark: SparkSession) -> str:
    """A checkpoint folder beside the session's tables, which all executors share; for sessions that name none."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
