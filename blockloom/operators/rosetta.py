"""Chain-neutral tables in the Rosetta form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.scalars import raw_payload, require
from blockloom.operators.rows import (
    BLOCK_KEYS,
    carried_columns,
    choose,
    key_columns,
    members_used,
    position_of,
    project,
    require_body,
    unnest_transactions,
)
from blockloom.schemas import rosetta

_FAMILY = "rosetta"


def _missing(items: str, member: str) -> Column:
    return F.coalesce(F.exists(F.col(items), lambda item: item[member].isNull()), F.lit(False))


def _require_timestamp(blocks: DataFrame) -> DataFrame:
    return blocks.where(require(F.col("timestamp").isNull(), "timestamp is required"))


def rosetta_transactions(
    blocks: DataFrame,
    *,
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
    spread: int | None = None,
) -> DataFrame:
    """One row per transaction, numbered by its place in the block.

    A transaction whose block has no timestamp (if that is asked for), and a transaction, operation or related
    transaction without its identifier, fails the job.
    """
    fields = choose(rosetta.TRANSACTIONS, columns)
    members = None if columns is None else members_used(fields, "transaction")
    checks = {
        "transaction_identifier": F.col("transaction.transaction_identifier").isNull(),
        "operations": _missing("transaction.operations", "operation_identifier"),
        "related_transactions": _missing(
            "transaction.related_transactions", "transaction_identifier"
        ),
    }
    carried = [
        *carried_columns(blocks, _FAMILY),
        F.col("block_identifier"),
        F.col("timestamp"),
    ]
    rows = unnest_transactions(
        require_body(blocks, _FAMILY), carried, members, with_position=True, spread=spread
    )
    if "block_timestamp" in {f.name for f in fields}:
        # Names the position, so that it is not pushed below the unnesting, where it
        # would meet blocks without transactions.
        untimed = F.col("timestamp").isNull() & (F.col("position") >= 0)
        rows = rows.where(require(untimed, "timestamp is required"))
    for member, failed in checks.items():
        if members is None or member in members:
            rows = rows.where(require(failed, f"identifier is missing in {member}"))
    return project(rows, fields, partition_by_size=partition_by_size, u64=u64)


def rosetta_blocks(
    blocks: DataFrame,
    *,
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
) -> DataFrame:
    """One row per block; count and hashes come from its transactions.

    A block without timestamp or parent, or with a transaction without
    identifier, fails the job.
    """
    fields = choose(rosetta.BLOCKS, columns)
    names = {f.name for f in fields}
    checked = require_body(blocks, _FAMILY)
    if "timestamp" in names:
        checked = _require_timestamp(checked)
    if names & {"parent_hash", "parent_number"}:
        checked = checked.where(
            require(F.col("parent_block_identifier").isNull(), "parent identifier is required")
        )
    if "transactions" in names:
        checked = checked.where(
            require(
                _missing("transactions", "transaction_identifier"),
                "identifier is missing in transactions",
            )
        )
    return project(
        checked,
        fields,
        position=position_of(blocks, _FAMILY),
        partition_by_size=partition_by_size,
        u64=u64,
    )


def rosetta_raw_transactions(
    resolved: DataFrame, *, partition_by_size: int = 0, u64: str = "long", keyed: bool = False, **payload
) -> DataFrame:
    """Streamed transactions as block info, place in the block and serialised transaction.

    Nothing but the event is required here: unset members hold their defaults. ``keyed``
    rows begin with the block's tag, height and hash, for events that are joined after.
    """
    info = rosetta.BLOCK_INFO
    carried = [
        *carried_columns(resolved, _FAMILY),
        F.struct(*[f.column_of(u64).alias(f.name) for f in info.fields]).alias("block_info"),
    ]
    if keyed:
        carried += key_columns(_FAMILY)
    rows = unnest_transactions(resolved, carried, None, with_position=True)
    data = raw_payload(F.col("transaction"), **payload)
    return project(
        rows.withColumn("transaction_data", data),
        rosetta.RAW_TRANSACTIONS,
        partition_by_size=partition_by_size,
        u64=u64,
        carried=BLOCK_KEYS if keyed else (),
    )
