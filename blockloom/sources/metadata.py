"""Static facts about a chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from blockloom.errors import NotFound


@dataclass(frozen=True)
class ChainMetadata:
    """First height of the chain, and how far behind the latest block reorganisations end."""

    block_start_height: int = 0
    irreversible_distance: int = 0


def read_metadata(table: DataFrame) -> ChainMetadata:
    """From a one-row table (block_start_height, irreversible_distance)."""
    row = table.select("block_start_height", "irreversible_distance").first()
    if row is None:
        raise NotFound("chain metadata is empty")
    return ChainMetadata(row["block_start_height"], row["irreversible_distance"])
