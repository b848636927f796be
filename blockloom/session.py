"""Session settings, and where intermediate tables may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join by hash where every partition of the smaller side is small, instead of
    # sorting wide rows.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "blockloom", **settings) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in (SETTINGS | settings).items():
        builder = builder.config(name, value)
    return builder.config("spark.ui.enabled", "false").getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that all executors share.

    The cluster names it in ``spark.checkpoint.dir``; a folder given to
    ``setCheckpointDir`` serves as well. Without either there is none.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
