"""Tables of the EVM chains: blocks and transactions, in batch and streamed form.

Given the result of :func:`blockloom.operators.events.resolve_events` a builder
makes the streamed table; given plain blocks it makes the batch one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.scalars import decimal38, raw_payload, require
from blockloom.operators.rows import (
    BLOCK_KEYS,
    carried_columns,
    choose,
    join_headers,
    key_columns,
    members_used,
    position_of,
    project,
    require_body,
    unnest_transactions,
)
from blockloom.schemas import evm
from blockloom.schemas.kinds import Field
from blockloom.schemas.tables import PARTITION_BY

_FAMILY = "evm"


def _with_receipts(rows: DataFrame, members: Iterable[str] | None) -> DataFrame:
    if members is not None and "receipt" not in members:
        return rows
    message = F.concat(F.lit("transaction without receipt, hash "), F.coalesce("transaction.hash", F.lit("unset")))
    return rows.where(require(F.col("transaction.receipt").isNull(), message))


def evm_transactions(
    blocks: DataFrame,
    *,
    chain: str = "ethereum",
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
    spread: int | None = None,
    keyed: bool = False,
) -> DataFrame:
    """One row per transaction of nested blocks (per event as well, when streamed).

    ``columns`` names the payload columns to build; only what they need is read.
    ``spread`` cuts blocks into pieces of that many transactions and deals these out.
    ``keyed`` rows begin with the block's tag, height and hash, for a join with events
    that comes after, see ``streamed``: then not whole blocks are shuffled for it.
    """
    fields = choose(evm.transactions(chain), columns)
    members = None if columns is None else members_used(fields, "transaction")
    if members and "receipt" in members and "hash" not in members:
        members.append("hash")
    carried = carried_columns(blocks, _FAMILY)
    if any(f.name == "block" for f in fields):
        carried.append(evm.BLOCK.column(F.col("header"), u64).alias("block"))
    if keyed:
        carried += key_columns(_FAMILY)
    rows = unnest_transactions(require_body(blocks, _FAMILY), carried, members, spread=spread)
    return project(
        _with_receipts(rows, members),
        fields,
        partition_by_size=partition_by_size,
        u64=u64,
        carried=BLOCK_KEYS if keyed else (),
    )


def evm_split_transactions(
    transactions: DataFrame,
    headers: DataFrame,
    *,
    chain: str = "ethereum",
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
    cut: Sequence[Column | str] | None = None,
) -> DataFrame:
    """The same table from the split layout, for chains with very uneven blocks.

    ``transactions`` has (tag, height, hash, transaction), ``headers`` (tag,
    height, hash, header). The join is left out when ``block`` is not asked for;
    otherwise the other columns are built before it. ``cut`` makes columns of these, such
    as a list's length, in their place: what it leaves out is not shuffled.
    """
    fields = choose(evm.transactions(chain), columns)
    members = None if columns is None else members_used(fields, "transaction")
    payload = tuple(f for f in fields if f.name != "block")
    joins = len(payload) < len(fields)
    table = project(
        _with_receipts(transactions, members),
        payload,
        position=position_of_split(transactions),
        partition_by_size=partition_by_size,
        u64=u64,
        carried=BLOCK_KEYS if joins else (),
    )
    if not joins:
        return table if cut is None else table.select(*cut)
    if cut is not None:
        table = table.select(*BLOCK_KEYS, *cut)
    names = [name for name in table.columns if name not in BLOCK_KEYS]
    names.insert(len(names) if cut is not None else _place_of_block(names, fields), "block")
    found = headers.where(require(F.col("header").isNull(), "header is required"))
    return join_headers(table, found, evm.BLOCK.column(F.col("header"), u64)).select(*names)


def _place_of_block(names: list[str], fields: Sequence[Field]) -> int:
    """Where ``block`` comes among a table's columns: after the field before it."""
    before = [f.name for f in fields]
    at = before.index("block")
    following = before[at + 1] if at + 1 < len(before) else PARTITION_BY
    return names.index(following)


def position_of_split(rows: DataFrame) -> Column:
    return F.col("event.sequence_num") if "event" in rows.columns else F.col("height")


def evm_blocks(
    blocks: DataFrame,
    *,
    chain: str = "ethereum",
    partition_by_size: int = 0,
    columns: Iterable[str] | None = None,
    u64: str = "long",
) -> DataFrame:
    """One row per block (per event, when streamed).

    A total difficulty that is no 38-digit whole number fails the job, whatever
    columns are asked for.
    """
    total = F.col("header.total_difficulty")
    message = F.concat(
        F.lit("failed to convert total difficulty (hash="), F.col("header.hash"), F.lit("): "), total
    )
    checked = require_body(blocks, _FAMILY).where(require(decimal38(total).isNull(), message))
    return project(
        checked,
        choose(evm.blocks(chain), columns),
        position=position_of(blocks, _FAMILY),
        partition_by_size=partition_by_size,
        u64=u64,
    )


def evm_raw_transactions(
    resolved: DataFrame, *, partition_by_size: int = 0, u64: str = "long", keyed: bool = False, **payload
) -> DataFrame:
    """Streamed transactions as key columns and the serialised transaction.

    ``payload`` goes to :func:`blockloom.functions.raw_payload`; ``keyed`` is that of
    :func:`evm_transactions`, for blocks that their events are joined to after.
    """
    carried = carried_columns(resolved, _FAMILY)
    if keyed:
        carried += key_columns(_FAMILY)
    rows = unnest_transactions(require_body(resolved, _FAMILY), carried, None)
    data = raw_payload(F.col("transaction"), **payload)
    return project(
        rows.withColumn("transaction_data", data),
        evm.RAW_TRANSACTIONS,
        partition_by_size=partition_by_size,
        u64=u64,
        carried=BLOCK_KEYS if keyed else (),
    )
