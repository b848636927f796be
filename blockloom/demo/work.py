"""Where the registered queries write what they read back."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from blockloom.session import CHECKPOINT_DIR, work_dir


def demo_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one.

    A local session, where one machine runs everything, gets one if it has none.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not named and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="demo-"))
    return work_dir(spark, purpose)
