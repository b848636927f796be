"""Columns of the EVM tables. Sources name members of the parsed rows."""

from __future__ import annotations

from blockloom.schemas.kinds import (
    AMOUNT,
    BYTES,
    COUNT,
    FLAG,
    TEXT,
    U64,
    Field,
    ListOf,
    Prebuilt,
    Struct,
)

# The short form of a header that is nested in transactions and used for uncles.
BLOCK = Struct(
    (
        Field("hash", TEXT, "hash", "Block hash"),
        Field("parent_hash", TEXT, "parent_hash", "Hash of the block before"),
        Field("number", U64, "number", "Height of the block"),
        Field("timestamp", U64, "timestamp", "Block time in unix seconds"),
        Field("miner", TEXT, "miner", "Address that earned the block reward"),
        Field("difficulty", U64, "difficulty", "Difficulty of this block"),
        Field("gas_limit", U64, "gas_limit", "Upper limit of gas in the block"),
        Field("gas_used", U64, "gas_used", "Gas spent by all transactions of the block"),
        Field("base_fee_per_gas", U64, "base_fee_per_gas", "Base fee of the protocol, per gas"),
    )
)

LOG = Struct(
    (
        Field("log_index", U64, "log_index", "Position of the log in its block"),
        Field("transaction_hash", TEXT, "transaction_hash", "Transaction that wrote the log"),
        Field("transaction_index", U64, "transaction_index", "Position of that transaction"),
        Field("block_hash", TEXT, "block_hash", "Block of the log"),
        Field("block_number", U64, "block_number", "Height of that block"),
        Field("address", TEXT, "address", "Contract that wrote the log"),
        Field("data", TEXT, "data", "Arguments that are not indexed, in hex"),
        Field("topics", ListOf(TEXT), "topics", "Indexed arguments, in hex"),
        Field("removed", FLAG, "removed", "Whether a reorganisation took the log back"),
    )
)

TRACE = Struct(
    (
        Field("transaction_hash", TEXT, "transaction_hash", "Transaction that was traced"),
        Field("transaction_index", U64, "transaction_index", "Position of that transaction"),
        Field("block_hash", TEXT, "block_hash", "Block of the trace"),
        Field("block_number", U64, "block_number", "Height of that block"),
        Field("from_address", TEXT, "from", "Caller"),
        Field("to_address", TEXT, "to", "Callee, created contract or beneficiary"),
        Field("value", AMOUNT, "value", "Wei moved; NULL if not a 38-digit whole number"),
        Field("value_string", TEXT, "value", "Wei moved, as text"),
        Field("input", TEXT, "input", "Data handed to the call"),
        Field("output", TEXT, "output", "Data returned, or code of a created contract"),
        Field("type", TEXT, "type", "Kind of trace"),
        Field("trace_type", TEXT, "trace_type", "Call, create, suicide, reward and the like"),
        Field("call_type", TEXT, "call_type", "Kind of call"),
        Field("gas", U64, "gas", "Gas handed to the call"),
        Field("gas_used", U64, "gas_used", "Gas spent by the call"),
        Field("subtraces", U64, "subtraces", "Number of direct sub-calls"),
        Field("trace_address", ListOf(U64), "trace_address", "Path in the tree of calls"),
        Field("error", TEXT, "error", "Why the call failed"),
        Field("status", U64, "status", "1 if the call and all above it worked, else 0"),
        Field("trace_id", TEXT, "trace_id", "Unique name of the trace"),
    )
)

WITHDRAWAL = Struct(
    (
        Field("index", U64, "index", "Running number of the withdrawal"),
        Field("validator_index", U64, "validator_index", "Validator that withdrew"),
        Field("address", TEXT, "address", "Who received it"),
        Field("amount", U64, "amount", "Amount in Gwei"),
    )
)

_RECEIPT = (
    Field("transaction_hash", TEXT, "transaction_hash", "Transaction of the receipt"),
    Field("transaction_index", U64, "transaction_index", "Position of that transaction"),
    Field("block_hash", TEXT, "block_hash", "Block of the transaction"),
    Field("block_number", U64, "block_number", "Height of that block"),
    Field("from_address", TEXT, "from", "Sender"),
    Field("to_address", TEXT, "to", "Receiver"),
    Field("cumulative_gas_used", U64, "cumulative_gas_used", "Gas spent in the block up to here"),
    Field("gas_used", U64, "gas_used", "Gas spent by this transaction"),
    Field("contract_address", TEXT, "contract_address", "Contract created, if any"),
    Field("logs", ListOf(LOG), "logs", "Logs of the transaction"),
    Field("logs_bloom", TEXT, "logs_bloom", "Bloom filter over the logs"),
    Field("root", TEXT, "root", "State root, on old blocks"),
    Field("type", U64, "type", "Type of transaction"),
    Field("status", U64, "status", "1 on success, 0 on failure"),
    Field("effective_gas_price", U64, "effective_gas_price", "Price paid per gas"),
)
_L1_GAS_USED = Field("l1_gas_used", U64, "l1_fee_info.l1_gas_used", "Gas of the call data on L1")
_L1_FEES = (
    _L1_GAS_USED,
    Field("l1_gas_price", U64, "l1_fee_info.l1_gas_price", "Price of gas on L1"),
    Field("l1_fee", U64, "l1_fee_info.l1_fee", "Wei paid on L1"),
    Field("l1_fee_scalar", TEXT, "l1_fee_info.l1_fee_scalar", "Factor on the L1 fee"),
)
_RECEIPT_EXTRAS = {"arbitrum": (_L1_GAS_USED,), "optimism": _L1_FEES}


def receipt(chain: str) -> Struct:
    """Receipts carry their L1 costs on the two roll-up chains."""
    return Struct((*_RECEIPT, *_RECEIPT_EXTRAS.get(chain, ())))


def transactions(chain: str) -> tuple[Field, ...]:
    return (
        Field("transaction_hash", TEXT, "transaction.hash", "Transaction hash"),
        Field("transaction_index", U64, "transaction.index", "Position in the block, from 0"),
        Field("block_hash", TEXT, "transaction.block_hash", "Block of the transaction"),
        Field("block_number", U64, "transaction.block_number", "Height of that block"),
        Field("block_timestamp", U64, "transaction.block_timestamp", "Block time, unix seconds"),
        Field("from_address", TEXT, "transaction.from", "Sender"),
        Field("to_address", TEXT, "transaction.to", "Receiver; empty when a contract is created"),
        Field("nonce", U64, "transaction.nonce", "Earlier transactions of the sender"),
        Field("value", AMOUNT, "transaction.value", "Wei sent; NULL if it does not fit"),
        Field("value_string", TEXT, "transaction.value", "Wei sent, as text"),
        Field("gas", U64, "transaction.gas", "Gas offered"),
        Field("gas_price", U64, "transaction.gas_price", "Wei offered per gas"),
        Field("input", TEXT, "transaction.input", "Data sent along"),
        Field("transaction_type", U64, "transaction.type", "Type of transaction"),
        Field("max_fee_per_gas", U64, "transaction.max_fee_per_gas", "Most to pay per gas"),
        Field(
            "max_priority_fee_per_gas",
            U64,
            "transaction.max_priority_fee_per_gas",
            "Most to tip per gas",
        ),
        Field("priority_fee_per_gas", U64, "transaction.priority_fee_per_gas", "Tip per gas"),
        Field("block", Prebuilt(BLOCK), "block", "Block of the transaction"),
        Field("receipt", receipt(chain), "transaction.receipt", "Receipt of the transaction"),
        Field("traces", ListOf(TRACE), "transaction.flattened_traces", "Traces, calls in order"),
    )


def blocks(chain: str) -> tuple[Field, ...]:
    common = (
        Field("hash", TEXT, "header.hash", "Block hash"),
        Field("parent_hash", TEXT, "header.parent_hash", "Hash of the block before"),
        Field("number", U64, "header.number", "Height of the block"),
        Field("nonce", TEXT, "header.nonce", "Proof-of-work nonce"),
        Field("sha3_uncles", TEXT, "header.sha3_uncles", "SHA3 over the uncles"),
        Field("logs_bloom", TEXT, "header.logs_bloom", "Bloom filter over the logs"),
        Field("transactions_root", TEXT, "header.transactions_root", "Root of the transactions"),
        Field("state_root", TEXT, "header.state_root", "Root of the state after the block"),
        Field("receipts_root", TEXT, "header.receipts_root", "Root of the receipts"),
        Field("miner", TEXT, "header.miner", "Address that earned the block reward"),
        Field("difficulty", U64, "header.difficulty", "Difficulty of this block"),
        Field("total_difficulty", AMOUNT, "header.total_difficulty", "Difficulty of all so far"),
        Field("size", U64, "header.size", "Size in bytes"),
        Field("extra_data", TEXT, "header.extra_data", "Free field of the miner"),
        Field("gas_limit", U64, "header.gas_limit", "Upper limit of gas in the block"),
        Field("gas_used", U64, "header.gas_used", "Gas spent by all transactions"),
        Field("timestamp", U64, "header.timestamp", "Block time in unix seconds"),
        Field("transaction_count", COUNT, "header.transactions", "Number of transactions"),
        Field("base_fee_per_gas", U64, "header.base_fee_per_gas", "Base fee, per gas"),
        Field("transactions", ListOf(TEXT), "header.transactions", "Transaction hashes"),
        Field("uncles", ListOf(TEXT), "header.uncles", "Hashes of the uncles"),
        Field("uncle_blocks", ListOf(BLOCK), "uncles", "The uncles' headers"),
    )
    if chain != "ethereum":
        return common
    return (
        *common,
        Field("withdrawals", ListOf(WITHDRAWAL), "header.withdrawals", "Stake withdrawals"),
        Field("withdrawals_root", TEXT, "header.withdrawals_root", "Root of the withdrawals"),
    )


RAW_TRANSACTIONS = (
    Field("transaction_hash", TEXT, "transaction.hash", "Transaction hash"),
    Field("transaction_index", U64, "transaction.index", "Position in the block, from 0"),
    Field("block_hash", TEXT, "transaction.block_hash", "Block of the transaction"),
    Field("block_number", U64, "transaction.block_number", "Height of that block"),
    Field("block_timestamp", U64, "transaction.block_timestamp", "Block time, unix seconds"),
    Field("transaction_data", BYTES, "transaction_data", "The whole transaction, serialised"),
)
