"""Columns of the Bitcoin tables. Sources name members of the parsed rows."""

from __future__ import annotations

from blockloom.schemas.kinds import (
    FLAG,
    TEXT,
    U64,
    Derived,
    Field,
    IndexedListOf,
    ListOf,
    Prebuilt,
    Struct,
)


def _header(prefix: str) -> tuple[Field, ...]:
    return (
        Field("hash", TEXT, prefix + "hash", "Block hash"),
        Field("size", U64, prefix + "size", "Size in bytes"),
        Field("stripped_size", U64, prefix + "stripped_size", "Size without witness data"),
        Field("weight", U64, prefix + "weight", "Weight by BIP 141"),
        Field("number", U64, prefix + "height", "Height of the block"),
        Field("version", U64, prefix + "version", "Block version"),
        Field("merkle_root", TEXT, prefix + "merkle_root", "Root over the transactions"),
        Field("timestamp", U64, prefix + "time", "Block time in unix seconds"),
        Field("nonce", U64, prefix + "nonce", "Proof-of-work nonce"),
        Field("bits", TEXT, prefix + "bits", "Target in compact form"),
        Field("difficulty", TEXT, prefix + "difficulty", "Difficulty, as text"),
        Field("chain_work", TEXT, prefix + "chain_work", "Hashes expected so far, in hex"),
        Field(
            "transaction_count", U64, prefix + "number_of_transactions", "Number of transactions"
        ),
        Field("previous_block_hash", TEXT, prefix + "previous_block_hash", "Block before"),
        Field("next_block_hash", TEXT, prefix + "next_block_hash", "Block after"),
    )


BLOCK = Struct(_header(""))

INPUTS = IndexedListOf(
    Field("index", U64, "", "Position of the input, from 0"),
    (
        Field("coinbase", TEXT, "minted", "Data of an input that creates coins"),
        Field("spent_transaction_hash", TEXT, "transaction_id", "Transaction being spent"),
        Field("spent_output_index", U64, "from_output_index", "Output of it being spent"),
        Field("script_asm", TEXT, "script_signature.assembly", "Script, in words"),
        Field("script_hex", TEXT, "script_signature.hex", "Script, in hex"),
        Field("sequence", U64, "sequence", "Sequence number of the input"),
        Field(
            "transaction_input_witnesses",
            ListOf(TEXT),
            "transaction_input_witnesses",
            "Witnesses, in hex",
        ),
        Field("type", TEXT, "from_output.script_public_key.type", "Type of the spent output"),
        Field("address", TEXT, "from_output.script_public_key.address", "Owner of that output"),
        Field("value", U64, "from_output.value", "Value of that output"),
    ),
)

OUTPUT = Struct(
    (
        Field("index", U64, "index", "Position of the output, from 0"),
        Field("script_asm", TEXT, "script_public_key.assembly", "Script, in words"),
        Field("script_hex", TEXT, "script_public_key.hex", "Script, in hex"),
        Field("type", TEXT, "script_public_key.type", "Type of the output"),
        Field("address", TEXT, "script_public_key.address", "Owner of the output"),
        Field("value", U64, "value", "Value of the output"),
    )
)

TRANSACTIONS = (
    # The identifier, not the hash over the witnesses as well.
    Field("hash", TEXT, "transaction.transaction_id", "Transaction identifier"),
    Field("size", U64, "transaction.size", "Size in bytes"),
    Field("virtual_size", U64, "transaction.virtual_size", "Size with discounted witnesses"),
    Field("weight", U64, "transaction.weight", "Weight by BIP 141"),
    Field("version", U64, "transaction.version", "Transaction version"),
    Field("lock_time", U64, "transaction.lock_time", "Earliest height or time"),
    Field("is_coinbase", FLAG, "transaction.mints", "Whether it creates coins"),
    Field("index", U64, "transaction.index", "Position in the block, from 0"),
    Field("block", Prebuilt(BLOCK), "block", "Block of the transaction"),
    Field("inputs", INPUTS, "transaction.inputs", "Inputs"),
    Field("outputs", ListOf(OUTPUT), "transaction.outputs", "Outputs"),
    Field("input_count", U64, "transaction.input_count", "Number of inputs"),
    Field("output_count", U64, "transaction.output_count", "Number of outputs"),
    Field("input_value", U64, "transaction.input_value", "Value of all inputs"),
    Field("output_value", U64, "transaction.output_value", "Value of all outputs"),
    Field("fee", U64, "transaction.fee", "Fee paid"),
)

BLOCKS = (
    *_header("header."),
    Field(
        "transactions",
        Derived(lambda transaction: transaction["transaction_id"]),
        "transactions",
        "Transaction identifiers",
    ),
)
