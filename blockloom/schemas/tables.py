"""The tables by key, with their schemas, and the chains that offer them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from blockloom.errors import NotFound
from blockloom.schemas import bitcoin, evm, rosetta
from blockloom.schemas.kinds import EVENT_TYPE, SEQUENCE, Field, struct_type, u64_type

NATIVE, ROSETTA = "native", "rosetta"
NONE, RAW = "none", "raw"

PARTITION_BY = "_partition_by"
RANGE_BY = "_repartition_by_range"
# Metadata of the column PARTITION_BY: the size its values are rounded down to.
PARTITION_SIZE = "partition_by_size"
SEQUENCE_NUMBER = "_sequence_number"

# The family of each chain and the formats enabled on its networks.
FAMILIES = {
    "arbitrum": "evm",
    "bitcoin": "bitcoin",
    "bsc": "evm",
    "ethereum": "evm",
    "optimism": "evm",
    "polygon": "evm",
}
NETWORK_FORMATS = {
    ("arbitrum", "mainnet"): (NATIVE,),
    ("bitcoin", "mainnet"): (NATIVE,),
    ("bsc", "mainnet"): (NATIVE,),
    ("ethereum", "goerli"): (NATIVE, ROSETTA),
    ("ethereum", "mainnet"): (NATIVE, ROSETTA),
    ("optimism", "mainnet"): (NATIVE,),
    ("polygon", "mainnet"): (NATIVE, ROSETTA),
}

EVENT_FIELDS = (
    Field(SEQUENCE_NUMBER, SEQUENCE, "event.sequence_num", "Position in the event log, rising"),
    Field("_event_type", EVENT_TYPE, "event.type", "UNKNOWN, BLOCK_ADDED or BLOCK_REMOVED"),
)


@dataclass(frozen=True)
class TableKey:
    table: str
    format: str = NATIVE
    encoding: str = NONE

    def __str__(self) -> str:
        return f"table={self.table}/format={self.format}/encoding={self.encoding}"

    @property
    def streamed(self) -> bool:
        return self.table.startswith("streamed_")


_EVM_TABLES = {
    TableKey("transactions"): evm.transactions,
    TableKey("blocks"): evm.blocks,
    TableKey("streamed_transactions"): evm.transactions,
    TableKey("streamed_blocks"): evm.blocks,
    TableKey("streamed_transactions", NATIVE, RAW): lambda chain: evm.RAW_TRANSACTIONS,
    TableKey("transactions", ROSETTA): lambda chain: rosetta.TRANSACTIONS,
    TableKey("blocks", ROSETTA): lambda chain: rosetta.BLOCKS,
    TableKey("streamed_transactions", ROSETTA, RAW): lambda chain: rosetta.RAW_TRANSACTIONS,
}
_BITCOIN_TABLES = {
    TableKey("transactions"): lambda chain: bitcoin.TRANSACTIONS,
    TableKey("blocks"): lambda chain: bitcoin.BLOCKS,
}
_TABLES = {"evm": _EVM_TABLES, "bitcoin": _BITCOIN_TABLES}


def family_of(chain: str) -> str:
    try:
        return FAMILIES[chain]
    except KeyError:
        raise NotFound(f"no tables for chain {chain!r}") from None


def tables_of(chain: str, network: str | None = None) -> list[TableKey]:
    """Table keys of a chain; with a network, only those whose format is enabled there."""
    keys = list(_TABLES[family_of(chain)])
    if network is None:
        return keys
    try:
        enabled = NETWORK_FORMATS[chain, network]
    except KeyError:
        raise NotFound(f"no network {network!r} on chain {chain!r}") from None
    return [key for key in keys if key.format in enabled]


def payload_fields(chain: str, key: TableKey) -> tuple[Field, ...]:
    try:
        fields = _TABLES[family_of(chain)][key]
    except KeyError:
        raise NotFound(f"no table {key} on chain {chain!r}") from None
    return fields(chain)


def layout_schema(streamed: bool, u64: str) -> list[T.StructField]:
    position = "event sequence" if streamed else "block height"
    return [
        T.StructField(
            PARTITION_BY,
            u64_type(u64),
            True,
            {"comment": f"Directory of the row: {position} rounded down to the partition size"},
        ),
        T.StructField(
            RANGE_BY, u64_type(u64), True, {"comment": f"Rows are range-partitioned by {position}"}
        ),
    ]


def table_schema(chain: str, key: TableKey, u64: str = "long") -> T.StructType:
    fields: Sequence[Field] = payload_fields(chain, key)
    if key.streamed:
        fields = (*EVENT_FIELDS, *fields)
    return T.StructType([*struct_type(fields, u64).fields, *layout_schema(key.streamed, u64)])
