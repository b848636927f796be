"""Columns of the chain-neutral Rosetta tables. Sources name members of the parsed rows."""

from __future__ import annotations

from blockloom.schemas.kinds import (
    AMOUNT,
    BYTES,
    COIN_ACTION,
    COUNT,
    DIRECTION,
    METADATA,
    TEXT,
    U64,
    Derived,
    Field,
    ListOf,
    Prebuilt,
    Struct,
)

RELATED_OPERATION = Struct(
    (
        Field("operation_index", U64, "index", "Index of the related operation"),
        Field("network_index", U64, "network_index", "Its index on the network"),
    )
)

OPERATION = Struct(
    (
        Field("operation_index", U64, "operation_identifier.index", "Index of the operation"),
        Field("network_index", U64, "operation_identifier.network_index", "Index on the network"),
        Field(
            "related_operations",
            ListOf(RELATED_OPERATION),
            "related_operations",
            "Operations this one belongs to",
        ),
        Field("type", TEXT, "type", "Type of operation"),
        Field("status", TEXT, "status", "Outcome, in the words of the network"),
        Field("account_address", TEXT, "account.address", "Account touched"),
        Field("sub_account_address", TEXT, "account.sub_account.address", "Part of the account"),
        Field("amount_value", AMOUNT, "amount.value", "Change; NULL if it does not fit"),
        Field("amount_string", TEXT, "amount.value", "Change, as text"),
        Field("amount_symbol", TEXT, "amount.currency.symbol", "Currency"),
        Field("amount_decimals", U64, "amount.currency.decimals", "Decimals of the currency"),
        Field(
            "coin_change_identifier",
            TEXT,
            "coin_change.coin_identifier.identifier",
            "Coin created or spent",
        ),
        Field("coin_change_action", COIN_ACTION, "coin_change.coin_action", "Created or spent"),
        Field("metadata", METADATA, "metadata", "Details of the network, as JSON"),
    )
)

RELATED_TRANSACTION = Struct(
    (
        Field("transaction_hash", TEXT, "transaction_identifier.hash", "Related transaction"),
        Field("direction", DIRECTION, "direction", "Which way the relation points"),
    )
)

TRANSACTIONS = (
    Field("transaction_hash", TEXT, "transaction.transaction_identifier.hash", "Hash"),
    Field("transaction_index", U64, "position", "Position in the block, from 0"),
    Field("block_hash", TEXT, "block_identifier.hash", "Block of the transaction"),
    Field("block_number", U64, "block_identifier.index", "Height of that block"),
    Field("block_timestamp", U64, "timestamp", "Block time in unix seconds"),
    Field("operations", ListOf(OPERATION), "transaction.operations", "Operations"),
    Field("operation_count", COUNT, "transaction.operations", "Number of operations"),
    Field(
        "related_transactions",
        ListOf(RELATED_TRANSACTION),
        "transaction.related_transactions",
        "Related transactions",
    ),
    Field("metadata", METADATA, "transaction.metadata", "Details of the network, as JSON"),
)

BLOCKS = (
    Field("hash", TEXT, "block_identifier.hash", "Block hash"),
    Field("parent_hash", TEXT, "parent_block_identifier.hash", "Hash of the block before"),
    Field("number", U64, "block_identifier.index", "Height of the block"),
    Field("parent_number", U64, "parent_block_identifier.index", "Height of the block before"),
    Field("timestamp", U64, "timestamp", "Block time in unix seconds"),
    Field("transaction_count", COUNT, "transactions", "Number of transactions"),
    Field(
        "transactions",
        Derived(lambda transaction: transaction["transaction_identifier"]["hash"]),
        "transactions",
        "Transaction hashes",
    ),
    Field("metadata", METADATA, "metadata", "Details of the network, as JSON"),
)

_IDENTIFIER = Struct(
    (
        Field("index", U64, "index", "Height of the block"),
        Field("hash", TEXT, "hash", "Block hash"),
    )
)

BLOCK_INFO = Struct(
    (
        Field("block_identifier", _IDENTIFIER, "block_identifier", "The block"),
        Field("parent_identifier", _IDENTIFIER, "parent_block_identifier", "The block before"),
        Field("timestamp", U64, "timestamp", "Block time in unix seconds"),
    )
)

RAW_TRANSACTIONS = (
    Field("block_info", Prebuilt(BLOCK_INFO), "block_info", "Block of the transaction"),
    Field("transaction_index", U64, "position", "Position in the block, from 0"),
    Field("transaction_data", BYTES, "transaction_data", "The whole transaction, serialised"),
)
