"""Small parsed blocks, written by hand."""

from __future__ import annotations

import json

from blockloom.schemas.inputs import BLOCKS, EVENTS
from blockloom.sources.blocks import parse_blocks


def blocks(spark, rows, family="evm"):
    texts = spark.createDataFrame([(json.dumps(row),) for row in rows], "value STRING")
    return parse_blocks(texts, family=family)


def events(spark, rows):
    """Rows of (sequence, type, tag, height, hash)."""
    return spark.createDataFrame(
        [(sequence, kind, (tag, height, name)) for sequence, kind, tag, height, name in rows],
        EVENTS,
    )


def evm_transaction(number, index, **members):
    return {
        "hash": f"t{number}-{index}",
        "index": index,
        "block_hash": f"b{number}",
        "block_number": number,
        "receipt": {"transaction_hash": f"t{number}-{index}"},
        **members,
    }


def evm_block(number, transactions=(), tag=1, uncles=(), **header):
    return {
        "tag": tag,
        "header": {"number": number, "hash": f"b{number}", "timestamp": number * 10, **header},
        "uncles": list(uncles),
        "transactions": list(transactions),
    }


def rosetta_block(number, transactions=(), **members):
    return {
        "tag": 1,
        "block_identifier": {"index": number, "hash": f"b{number}"},
        "parent_block_identifier": {"index": number - 1, "hash": f"b{number - 1}"},
        "timestamp": number * 10,
        "transactions": list(transactions),
        **members,
    }


__all__ = ["BLOCKS", "blocks", "events", "evm_block", "evm_transaction", "rosetta_block"]
