"""Tables of Bitcoin."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.functions.scalars import require
from blockloom.operators.rows import (
    carried_columns,
    choose,
    join_headers,
    members_used,
    position_of,
    project,
    require_body,
    unnest_transactions,
)
from blockloom.schemas import bitcoin

_FAMILY = "bitcoin"


def bitcoin_transactions(
    blocks: DataFrame,
    *,
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
    spread: int | None = None,
) -> DataFrame:
    """One row per transaction of nested blocks; ``columns`` limits what is read."""
    fields = choose(bitcoin.TRANSACTIONS, columns)
    members = None if columns is None else members_used(fields, "transaction")
    carried = carried_columns(blocks, _FAMILY)
    if any(f.name == "block" for f in fields):
        carried.append(bitcoin.BLOCK.column(F.col("header"), u64).alias("block"))
    rows = unnest_transactions(require_body(blocks, _FAMILY), carried, members, spread=spread)
    return project(rows, fields, partition_by_size=partition_by_size, u64=u64)


def bitcoin_split_transactions(
    transactions: DataFrame,
    headers: DataFrame,
    *,
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
) -> DataFrame:
    """The same table from the split layout; headers are joined only for ``block``."""
    fields = choose(bitcoin.TRANSACTIONS, columns)
    rows = transactions
    if any(f.name == "block" for f in fields):
        found = headers.where(require(F.col("header").isNull(), "header is required"))
        rows = join_headers(transactions, found, bitcoin.BLOCK.column(F.col("header"), u64))
    return project(
        rows,
        fields,
        position=F.col("height"),
        partition_by_size=partition_by_size,
        u64=u64,
    )


def bitcoin_blocks(
    blocks: DataFrame,
    *,
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
) -> DataFrame:
    """One row per block, with the identifiers of its transactions."""
    return project(
        require_body(blocks, _FAMILY),
        choose(bitcoin.BLOCKS, columns),
        position=position_of(blocks, _FAMILY),
        partition_by_size=partition_by_size,
        u64=u64,
    )
