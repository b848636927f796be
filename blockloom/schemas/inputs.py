"""Schemas of what is read: parsed blocks of each family, and chain events.

Unsigned 64-bit values are BIGINT here, which can't hold the upper half of them;
``block_schema`` gives the same schemas with DECIMAL(20,0), for builders that run with
``u64="decimal"``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
FLAG = T.BooleanType()
TEXTS = T.ArrayType(TEXT)
TEXT_MAP = T.MapType(TEXT, TEXT)


def _struct(members: Mapping[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in members.items()])


def _list(members: Mapping[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(_struct(members))


# What receipts, logs and traces all repeat about where they belong.
_PLACE = {
    "transaction_hash": TEXT,
    "transaction_index": LONG,
    "block_hash": TEXT,
    "block_number": LONG,
}
_ENDS = {"from": TEXT, "to": TEXT}

_LOG = {
    **_PLACE,
    "log_index": LONG,
    "address": TEXT,
    "data": TEXT,
    "topics": TEXTS,
    "removed": FLAG,
}
_TRACE = {
    **_PLACE,
    **_ENDS,
    "value": TEXT,
    "input": TEXT,
    "output": TEXT,
    "type": TEXT,
    "trace_type": TEXT,
    "call_type": TEXT,
    "gas": LONG,
    "gas_used": LONG,
    "subtraces": LONG,
    "trace_address": T.ArrayType(LONG),
    "error": TEXT,
    "status": LONG,
    "trace_id": TEXT,
}
_RECEIPT = {
    **_PLACE,
    **_ENDS,
    "cumulative_gas_used": LONG,
    "gas_used": LONG,
    "contract_address": TEXT,
    "logs": _list(_LOG),
    "logs_bloom": TEXT,
    "root": TEXT,
    "type": LONG,
    "status": LONG,
    "effective_gas_price": LONG,
    "l1_fee_info": _struct(
        {"l1_gas_used": LONG, "l1_gas_price": LONG, "l1_fee": LONG, "l1_fee_scalar": TEXT}
    ),
}
EVM_TRANSACTION = _struct(
    {
        "hash": TEXT,
        "index": LONG,
        "block_hash": TEXT,
        "block_number": LONG,
        "block_timestamp": LONG,
        **_ENDS,
        "nonce": LONG,
        "value": TEXT,
        "gas": LONG,
        "gas_price": LONG,
        "input": TEXT,
        "type": LONG,
        "max_fee_per_gas": LONG,
        "max_priority_fee_per_gas": LONG,
        "priority_fee_per_gas": LONG,
        "receipt": _struct(_RECEIPT),
        "flattened_traces": _list(_TRACE),
    }
)
_EVM_SHORT_HEADER = {
    "hash": TEXT,
    "parent_hash": TEXT,
    "number": LONG,
    "timestamp": LONG,
    "miner": TEXT,
    "difficulty": LONG,
    "gas_limit": LONG,
    "gas_used": LONG,
    "base_fee_per_gas": LONG,
}
_EVM_HEADER = {
    **_EVM_SHORT_HEADER,
    "nonce": TEXT,
    "sha3_uncles": TEXT,
    "logs_bloom": TEXT,
    "transactions_root": TEXT,
    "state_root": TEXT,
    "receipts_root": TEXT,
    "total_difficulty": TEXT,
    "size": LONG,
    "extra_data": TEXT,
    "transactions": TEXTS,
    "uncles": TEXTS,
    "withdrawals": _list(
        {"index": LONG, "validator_index": LONG, "address": TEXT, "amount": LONG}
    ),
    "withdrawals_root": TEXT,
}
_EVM_HEADERS = {
    "tag": LONG,
    "header": _struct(_EVM_HEADER),
    "uncles": _list(_EVM_SHORT_HEADER),
}
EVM_HEADERS = _struct(_EVM_HEADERS)
EVM_BLOCKS = _struct({**_EVM_HEADERS, "transactions": T.ArrayType(EVM_TRANSACTION)})

_BITCOIN_HEADER = {
    "hash": TEXT,
    "size": LONG,
    "stripped_size": LONG,
    "weight": LONG,
    "height": LONG,
    "version": LONG,
    "merkle_root": TEXT,
    "time": LONG,
    "nonce": LONG,
    "bits": TEXT,
    "difficulty": TEXT,
    "chain_work": TEXT,
    "number_of_transactions": LONG,
    "previous_block_hash": TEXT,
    "next_block_hash": TEXT,
}
BITCOIN_TRANSACTION = _struct(
    {
        "transaction_id": TEXT,
        "hash": TEXT,
        "size": LONG,
        "virtual_size": LONG,
        "weight": LONG,
        "version": LONG,
        "lock_time": LONG,
        "mints": FLAG,
        "index": LONG,
        "inputs": _list(
            {
                "minted": TEXT,
                "transaction_id": TEXT,
                "from_output_index": LONG,
                "script_signature": _struct({"assembly": TEXT, "hex": TEXT}),
                "sequence": LONG,
                "transaction_input_witnesses": TEXTS,
                "from_output": _struct(
                    {
                        "script_public_key": _struct({"type": TEXT, "address": TEXT}),
                        "value": LONG,
                    }
                ),
            }
        ),
        "outputs": _list(
            {
                "index": LONG,
                "script_public_key": _struct(
                    {"assembly": TEXT, "hex": TEXT, "type": TEXT, "address": TEXT}
                ),
                "value": LONG,
            }
        ),
        "input_count": LONG,
        "output_count": LONG,
        "input_value": LONG,
        "output_value": LONG,
        "fee": LONG,
    }
)
BITCOIN_HEADERS = _struct({"tag": LONG, "header": _struct(_BITCOIN_HEADER)})
BITCOIN_BLOCKS = _struct(
    {
        "tag": LONG,
        "header": _struct(_BITCOIN_HEADER),
        "transactions": T.ArrayType(BITCOIN_TRANSACTION),
    }
)

_INDEXES = {"index": LONG, "network_index": LONG}
_HASH = _struct({"hash": TEXT})
_IDENTIFIER = _struct({"index": LONG, "hash": TEXT})
# Values of metadata are JSON text.
ROSETTA_TRANSACTION = _struct(
    {
        "transaction_identifier": _HASH,
        "operations": _list(
            {
                "operation_identifier": _struct(_INDEXES),
                "related_operations": _list(_INDEXES),
                "type": TEXT,
                "status": TEXT,
                "account": _struct({"address": TEXT, "sub_account": _struct({"address": TEXT})}),
                "amount": _struct(
                    {"value": TEXT, "currency": _struct({"symbol": TEXT, "decimals": LONG})}
                ),
                "coin_change": _struct(
                    {"coin_identifier": _struct({"identifier": TEXT}), "coin_action": TEXT}
                ),
                "metadata": TEXT_MAP,
            }
        ),
        "related_transactions": _list({"transaction_identifier": _HASH, "direction": TEXT}),
        "metadata": TEXT_MAP,
    }
)
ROSETTA_BLOCKS = _struct(
    {
        "tag": LONG,
        "block_identifier": _IDENTIFIER,
        "parent_block_identifier": _IDENTIFIER,
        "timestamp": LONG,
        "metadata": TEXT_MAP,
        "transactions": T.ArrayType(ROSETTA_TRANSACTION),
    }
)

EVENTS = _struct(
    {
        "sequence_num": LONG,
        "type": TEXT,
        "block": _struct({"tag": LONG, "height": LONG, "hash": TEXT}),
    }
)

BLOCKS = {"evm": EVM_BLOCKS, "bitcoin": BITCOIN_BLOCKS, "rosetta": ROSETTA_BLOCKS}


def _unsigned(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _unsigned(f.dataType), True) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_unsigned(dtype.elementType))
    return T.DecimalType(20, 0) if isinstance(dtype, T.LongType) else dtype


def block_schema(family: str, u64: str = "long") -> T.StructType:
    """Schema of parsed blocks; with ``u64="decimal"`` unsigned values are read exactly."""
    schema = BLOCKS[family]
    if u64 == "long":
        return schema
    if u64 != "decimal":
        raise ValueError(f"u64 must be long or decimal: {u64}")
    return T.StructType(
        [f if f.name == "tag" else T.StructField(f.name, _unsigned(f.dataType)) for f in schema]
    )


# Where each family keeps the number and the hash of a block.
HEIGHT = {
    "evm": "header.number",
    "bitcoin": "header.height",
    "rosetta": "block_identifier.index",
}
HASH = {"evm": "header.hash", "bitcoin": "header.hash", "rosetta": "block_identifier.hash"}
# The member without which a block cannot be used.
BODY = {"evm": "header", "bitcoin": "header", "rosetta": "block_identifier"}


def split_transactions(family: str) -> T.StructType:
    """Schema of one row per transaction, kept apart from the block headers."""
    members = {
        "evm": EVM_TRANSACTION,
        "bitcoin": BITCOIN_TRANSACTION,
        "rosetta": ROSETTA_TRANSACTION,
    }
    return _struct({"tag": LONG, "height": LONG, "hash": TEXT, "transaction": members[family]})
