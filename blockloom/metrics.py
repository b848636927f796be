"""Counters that Spark collects while a query runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BLOCKS_PROCESSED = "blocks_processed"


def count_blocks(blocks: DataFrame, observation: Observation | str = BLOCKS_PROCESSED) -> DataFrame:
    """Count the blocks (or events) that pass, before they are unnested.

    With a name, the count shows in the progress of a streaming query; with an
    ``Observation`` it can be read after the first action.
    """
    return blocks.observe(observation, F.count(F.lit(1)).alias(BLOCKS_PROCESSED))
