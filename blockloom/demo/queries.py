"""The registered queries. Each reads whole tables and gives a flat result.

Lists are unnested, struct members pulled up and decimals given as text, so that
results can be compared with SQL value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.builders import block_family, build
from blockloom.demo import ledger
from blockloom.demo.work import demo_dir
from blockloom.functions import scalars
from blockloom.ledger import BatchQuery, Ledger, StreamQuery
from blockloom.metrics import BLOCKS_PROCESSED
from blockloom.operators.bitcoin import (
    bitcoin_blocks,
    bitcoin_split_transactions,
    bitcoin_transactions,
)
from blockloom.operators.events import (
    BROADCAST_BYTES,
    EventStats,
    event_stats,
    missing_blocks,
    resolve_events,
)
from blockloom.operators.evm import (
    evm_blocks,
    evm_raw_transactions,
    evm_split_transactions,
    evm_transactions,
)
from blockloom.operators.rosetta import (
    rosetta_blocks,
    rosetta_raw_transactions,
    rosetta_transactions,
)
from blockloom.operators.rows import BLOCK_KEYS, key_columns, require_body, streamed, unnest
from blockloom.plans import ranges
from blockloom.plans.catalog import create_tables, list_tables, table_path
from blockloom.schemas.bitcoin import INPUTS
from blockloom.schemas.inputs import split_transactions
from blockloom.schemas.tables import PARTITION_BY, RANGE_BY, TableKey
from blockloom.sinks.layout import read_table, write_table
from blockloom.sinks.slices import processed, read_slices
from blockloom.sources.blocks import (
    BlockStore,
    SplitStore,
    parse_blocks,
    read_block_store,
    read_blocks,
    scan_blocks,
    store_sizes,
    write_block_store,
)
from blockloom.sources.events import (
    read_event_store,
    scan_events,
    stream_events,
    write_event_store,
)
from blockloom.sources.metadata import ChainMetadata, read_metadata
from blockloom.streaming.streams import (
    backfill,
    read_streamed,
    replay,
    start_position,
    stream_table,
)

Query = Callable[[SparkSession, str], DataFrame]
PARTITION_SIZE = 1000
# Events in a file that lands for a stream.
LANDED = 1_000_000
_REGISTRY: dict[str, Query] = {}


def query(build_result: Query) -> Query:
    _REGISTRY[build_result.__name__] = build_result
    return build_result


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _digits(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast("string")


def _length(items: str) -> Column:
    """-1 tells a NULL list from an empty one."""
    return F.coalesce(F.size(items), F.lit(-1)).cast("bigint")


def _numbered(df: DataFrame, items: str, item: str, carried: list[str]) -> DataFrame:
    rows = unnest(df, items, item, carried, "position")
    return rows.withColumn("position", F.col("position").cast("bigint"))


def _layout() -> list[Column]:
    return [F.col(PARTITION_BY), F.col(RANGE_BY)]


_TX = [
    "transaction_hash",
    "transaction_index",
    "block_hash",
    "block_number",
    "block_timestamp",
    "from_address",
    "to_address",
    "nonce",
    "value_string",
    "gas",
    "gas_price",
    "input",
    "transaction_type",
    "max_fee_per_gas",
    "max_priority_fee_per_gas",
    "priority_fee_per_gas",
]


def _payload() -> list[Column | str]:
    """What is shown of a transactions table beside the block, lists by their length."""
    return [
        *_TX,
        "value",
        F.col("receipt.status").alias("status"),
        F.col("receipt.contract_address").alias("contract_address"),
        _length("receipt.logs").alias("logs"),
        _length("traces").alias("traces"),
        *_layout(),
    ]


def _flat_transactions(transactions: DataFrame, *prefix: str) -> DataFrame:
    return _beside_block(transactions.select(*prefix, *_payload(), "block"), *prefix)


def _beside_block(payload: DataFrame, *prefix: str) -> DataFrame:
    return payload.select(
        *prefix,
        *_TX,
        _digits("value").alias("value"),
        F.col("block.parent_hash").alias("parent_hash"),
        F.col("block.miner").alias("miner"),
        F.col("block.timestamp").alias("mined_at"),
        F.col("block.base_fee_per_gas").alias("base_fee_per_gas"),
        "status",
        "contract_address",
        "logs",
        "traces",
        *_layout(),
    )


# --- positions and ranges ----------------------------------------------------


def _heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("height"))


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.table(spark, sf_dir, "events").select(F.col("event_id").alias("sequence_num"))


@query
def tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranges.tip(_heights(spark, sf_dir), ledger.METADATA, height="height")
    return spark.createDataFrame([(found,)], "tip_height BIGINT")


@query
def earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured start height, and how many blocks lie at or above it."""
    start = ranges.earliest(ledger.METADATA)
    return _heights(spark, sf_dir).agg(
        F.lit(start).cast("bigint").alias("start_height"),
        F.count(F.when(F.col("height") >= start, 1)).alias("blocks"),
    )


@query
def stream_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranges.stream_tip(_sequences(spark, sf_dir))
    return spark.createDataFrame([(found,)], "stream_tip BIGINT")


@query
def stream_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranges.stream_earliest(_sequences(spark, sf_dir))
    return spark.createDataFrame([(found,)], "stream_earliest BIGINT")


@query
def batch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in the range that a query without bounds resolves to."""
    heights = _heights(spark, sf_dir)
    span = ranges.resolve_batch_range(heights, ledger.METADATA, height="height")
    return scan_blocks(heights, span.start, span.end, height="height").agg(
        F.min("height").alias("first_height"),
        F.max("height").alias("last_height"),
        F.count(F.lit(1)).alias("blocks"),
    )


@query
def stream_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the range that a query reaching past both ends resolves to."""
    sequences = _sequences(spark, sf_dir)
    span = ranges.resolve_stream_range(sequences, -1, 2**62)
    return scan_events(sequences, span.start, span.end).agg(
        F.min("sequence_num").alias("first_sequence"),
        F.max("sequence_num").alias("last_sequence"),
        F.count(F.lit(1)).alias("events"),
    )


@query
def batch_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices of the whole range, in as many plans as their limit asks for."""
    span = ranges.resolve_batch_range(_heights(spark, sf_dir), ledger.METADATA, height="height")
    plans = [ranges.plan_batch_slices(spark, part) for part in ranges.batch_plans(span)]
    return reduce(DataFrame.union, plans)


@query
def stream_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices of the whole log, in as many plans as their limit asks for."""
    span = ranges.resolve_stream_range(_sequences(spark, sf_dir))
    plans = [ranges.plan_stream_slices(spark, part, 64) for part in ranges.stream_plans(span, 64)]
    return reduce(DataFrame.union, plans)


@query
def scan_blocks_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block headers from the chain's start to its tip."""
    blocks = ledger.evm_headers(spark, sf_dir)
    heights = _heights(spark, sf_dir)
    span = ranges.resolve_batch_range(heights, ledger.METADATA, height="height")
    return scan_blocks(blocks, span.start, span.end).select(
        F.col("header.number").alias("number"),
        F.col("header.hash").alias("hash"),
        F.col("header.timestamp").alias("timestamp"),
    )


@query
def scan_events_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = ranges.resolve_stream_range(_sequences(spark, sf_dir))
    events = scan_events(ledger.chain_events(spark, sf_dir), span.start, span.end)
    return events.select(
        "sequence_num",
        scalars.enum_name(F.col("type"), scalars.EVENT_TYPES).alias("type"),
        "block.*",
    )


@query
def missing_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line item, as gaps in the heights of the line items."""
    heights = _heights(spark, sf_dir)
    end = ranges.tip(heights, ledger.METADATA, height="height")
    lines = ledger.lines(spark, sf_dir).select(F.col("k").alias("height"))
    return ranges.missing_heights(lines, 0, end, height="height")


# --- scalar functions --------------------------------------------------------


@query
def decimal_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = ledger.lines(spark, sf_dir).select(
        "k", "line", "part", "supp", ledger.line_amount().alias("amount")
    )
    return amounts.withColumn("value", _digits(scalars.decimal38(F.col("amount"))))


@query
def decimal_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ledger.orders(spark, sf_dir)
    text = F.when(F.col("cents") % 2 == 0, F.col("cents").cast("string")).otherwise(F.lit(""))
    return orders.select(
        "k", _digits(scalars.decimal38_strict(text, F.col("k").cast("string"))).alias("value")
    )


@query
def partition_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per directory, for three partition sizes."""
    counted = [
        ledger.lines(spark, sf_dir)
        .groupBy(scalars.partition_floor(F.col("k"), size).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("transactions"))
        .select(F.lit(size).cast("bigint").alias("size"), "bucket", "transactions")
        for size in (0, 7, PARTITION_SIZE)
    ]
    return counted[0].union(counted[1]).union(counted[2])


@query
def epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.lines(spark, sf_dir).select("k", "line", "part", "supp", "seconds")


@query
def metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ledger.orders(spark, sf_dir)
    return orders.select(
        "k", scalars.metadata_json(ledger.order_metadata()).alias("metadata")
    )


@query
def enum_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types from numbers: unset, known and unknown ones."""
    number = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 4)
    name = scalars.enum_name(number, scalars.EVENT_TYPES, numeric=True)
    orders = ledger.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", name.alias("event_type"))


# --- EVM ---------------------------------------------------------------------


@query
def evm_transactions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions, beside the header of their order."""
    return _beside_block(
        evm_split_transactions(
            ledger.evm_split_transactions(spark, sf_dir),
            ledger.evm_split_headers(spark, sf_dir),
            partition_by_size=PARTITION_SIZE,
            cut=_payload(),
        )
    )


@query
def evm_transactions_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as transactions, unnested from the block of their order."""
    return _flat_transactions(
        evm_transactions(ledger.evm_blocks(spark, sf_dir), partition_by_size=PARTITION_SIZE)
    )


@query
def evm_transaction_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow projection: senders' largest amounts by directory, from three columns."""
    narrow = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "from", "value"]),
        ledger.evm_split_headers(spark, sf_dir),
        columns=["from_address", "value"],
        partition_by_size=PARTITION_SIZE,
    )
    return narrow.groupBy("from_address", PARTITION_BY).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("value").alias("valid"),
        _digits(F.max("value")).alias("largest"),
    )


def _flat_blocks(blocks: DataFrame, *prefix: str) -> DataFrame:
    return blocks.select(
        *prefix,
        "hash",
        "parent_hash",
        "number",
        "nonce",
        "sha3_uncles",
        "logs_bloom",
        "transactions_root",
        "state_root",
        "receipts_root",
        "miner",
        "difficulty",
        _digits("total_difficulty").alias("total_difficulty"),
        "size",
        "extra_data",
        "gas_limit",
        "gas_used",
        "timestamp",
        "transaction_count",
        "base_fee_per_gas",
        _length("transactions").alias("transactions"),
        _length("uncles").alias("uncles"),
        _length("uncle_blocks").alias("uncle_blocks"),
        _length("withdrawals").alias("withdrawals"),
        "withdrawals_root",
        *_layout(),
    )


@query
def evm_blocks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_blocks(
        evm_blocks(ledger.evm_headers(spark, sf_dir), partition_by_size=PARTITION_SIZE)
    )


def _block_lists(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    blocks = evm_blocks(ledger.evm_headers(spark, sf_dir), columns=["number", column])
    return _numbered(blocks, column, "item", ["number"])


@query
def evm_block_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_lists(spark, sf_dir, "transactions")


@query
def evm_uncle_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_lists(spark, sf_dir, "uncles")


@query
def evm_uncle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _block_lists(spark, sf_dir, "uncle_blocks")
    return listed.select(F.col("number").alias("block_number"), "position", "item.*")


@query
def evm_withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _block_lists(spark, sf_dir, "withdrawals")
    return listed.select("number", "position", "item.*")


def _receipts(spark: SparkSession, sf_dir: str, chain: str, *extras: str) -> DataFrame:
    transactions = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "receipt"]),
        ledger.evm_split_headers(spark, sf_dir),
        chain=chain,
        columns=["receipt"],
    )
    names = [
        "transaction_hash",
        "transaction_index",
        "block_hash",
        "block_number",
        "from_address",
        "to_address",
        "cumulative_gas_used",
        "gas_used",
        "contract_address",
        "logs_bloom",
        "root",
        "type",
        "status",
        "effective_gas_price",
        *extras,
    ]
    return transactions.select(*[f"receipt.{name}" for name in names])


@query
def evm_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _receipts(spark, sf_dir, "ethereum")


@query
def evm_receipts_arbitrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _receipts(spark, sf_dir, "arbitrum", "l1_gas_used")


@query
def evm_receipts_optimism(spark: SparkSession, sf_dir: str) -> DataFrame:
    fees = ("l1_gas_used", "l1_gas_price", "l1_fee", "l1_fee_scalar")
    return _receipts(spark, sf_dir, "optimism", *fees)


def _split_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "receipt"]),
        ledger.evm_split_headers(spark, sf_dir),
        columns=["receipt"],
    )
    return unnest(transactions, "receipt.logs", "log", []).select("log.*")


@query
def evm_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_logs(spark, sf_dir).select(
        "log_index",
        "transaction_hash",
        "transaction_index",
        "block_hash",
        "block_number",
        "address",
        "data",
        _length("topics").alias("topics"),
        F.col("removed").cast("bigint").alias("removed"),
    )


@query
def evm_log_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _split_logs(spark, sf_dir)
    return _numbered(logs, "topics", "topic", ["transaction_hash", "log_index"])


def _split_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["flattened_traces"]),
        ledger.evm_split_headers(spark, sf_dir),
        columns=["traces"],
    )
    return unnest(transactions, "traces", "trace", []).select("trace.*")


@query
def evm_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = _split_traces(spark, sf_dir)
    return traces.withColumns(
        {"value": _digits("value"), "trace_address": _length("trace_address")}
    )


@query
def evm_trace_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(_split_traces(spark, sf_dir), "trace_address", "step", ["trace_id"])


@query
def evm_unsigned_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsigned 64-bit columns as DECIMAL(20,0) instead of BIGINT."""
    transactions = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "nonce", "gas_price"]),
        ledger.evm_split_headers(spark, sf_dir),
        columns=["transaction_hash", "nonce", "gas_price"],
        partition_by_size=PARTITION_SIZE,
        u64="decimal",
    )
    return transactions.select(
        "transaction_hash",
        *[_digits(c).alias(c) for c in ("nonce", "gas_price", PARTITION_BY, RANGE_BY)],
    )


@query
def evm_parsed_json_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written as JSON text and parsed again."""
    blocks = ledger.evm_blocks(spark, sf_dir, ["hash", "nonce", "value"])
    texts = blocks.select(F.to_json(F.struct("*")).alias("value"))
    transactions = evm_transactions(
        parse_blocks(texts), columns=["transaction_hash", "nonce", "value"]
    )
    return transactions.select(
        "transaction_hash", "nonce", _digits("value").alias("value"), RANGE_BY
    )


# --- Bitcoin -----------------------------------------------------------------


def _flat_bitcoin(transactions: DataFrame) -> DataFrame:
    [flag] = [f.name for f in transactions.schema if f.dataType == T.BooleanType()]
    return transactions.select(
        "hash",
        "size",
        "virtual_size",
        "weight",
        "version",
        "lock_time",
        F.col(flag).cast("bigint").alias("mints"),
        "index",
        F.col("block.hash").alias("block_hash"),
        F.col("block.number").alias("block_number"),
        F.col("block.timestamp").alias("block_timestamp"),
        F.col("block.chain_work").alias("chain_work"),
        F.col("block.transaction_count").alias("block_transactions"),
        _length("inputs").alias("inputs"),
        _length("outputs").alias("outputs"),
        "input_count",
        "output_count",
        "input_value",
        "output_value",
        "fee",
        *_layout(),
    )


@query
def bitcoin_transactions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_bitcoin(
        bitcoin_split_transactions(
            ledger.bitcoin_split_transactions(spark, sf_dir),
            ledger.bitcoin_split_headers(spark, sf_dir),
            partition_by_size=PARTITION_SIZE,
        )
    )


@query
def bitcoin_transactions_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_bitcoin(
        bitcoin_transactions(
            ledger.bitcoin_blocks(spark, sf_dir), partition_by_size=PARTITION_SIZE
        )
    )


@query
def bitcoin_blocks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = bitcoin_blocks(
        ledger.bitcoin_blocks(spark, sf_dir), partition_by_size=PARTITION_SIZE
    )
    return blocks.withColumn(
        "transactions", F.coalesce(F.array_join("transactions", ","), F.lit("none"))
    )


def _bitcoin_lists(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    transactions = bitcoin_split_transactions(
        ledger.bitcoin_split_transactions(spark, sf_dir, ["transaction_id", column]),
        ledger.bitcoin_split_headers(spark, sf_dir),
        columns=["hash", column],
    )
    return unnest(transactions, column, "item", ["hash"]).select("hash", "item.*")


@query
def bitcoin_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _bitcoin_lists(spark, sf_dir, "inputs")
    [minted] = [f.name for f in INPUTS.fields if f.source == "minted"]
    return inputs.withColumnRenamed(minted, "minted").withColumn(
        "transaction_input_witnesses", _length("transaction_input_witnesses")
    )


@query
def bitcoin_input_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _bitcoin_lists(spark, sf_dir, "inputs").withColumnRenamed("index", "input")
    return _numbered(inputs, "transaction_input_witnesses", "witness", ["hash", "input"])


@query
def bitcoin_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bitcoin_lists(spark, sf_dir, "outputs")


# --- Rosetta -----------------------------------------------------------------


@query
def rosetta_transactions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = rosetta_transactions(
        ledger.rosetta_blocks(spark, sf_dir), partition_by_size=PARTITION_SIZE
    )
    return transactions.withColumns(
        {
            "operations": _length("operations"),
            "related_transactions": _length("related_transactions"),
        }
    )


@query
def rosetta_blocks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = rosetta_blocks(
        ledger.rosetta_blocks(spark, sf_dir), partition_by_size=PARTITION_SIZE
    )
    return blocks.withColumn(
        "transactions", F.coalesce(F.array_join("transactions", ","), F.lit("none"))
    )


def _rosetta_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = rosetta_transactions(
        ledger.rosetta_blocks(spark, sf_dir), columns=["transaction_hash", "operations"]
    )
    return unnest(transactions, "operations", "op", ["transaction_hash"]).select(
        "transaction_hash", "op.*"
    )


@query
def rosetta_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rosetta_operations(spark, sf_dir).withColumns(
        {
            "amount_value": _digits("amount_value"),
            "related_operations": _length("related_operations"),
        }
    )


@query
def rosetta_related_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    operations = _rosetta_operations(spark, sf_dir)
    carried = ["transaction_hash", F.col("operation_index").alias("operation")]
    related = unnest(operations, "related_operations", "related", carried)
    return related.select("transaction_hash", "operation", "related.*")


@query
def rosetta_related_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = rosetta_transactions(
        ledger.rosetta_blocks(spark, sf_dir),
        columns=["transaction_hash", "related_transactions"],
    )
    carried = [F.col("transaction_hash").alias("of_transaction")]
    related = unnest(transactions, "related_transactions", "related", carried)
    return related.select("of_transaction", "related.*")


@query
def rosetta_parsed_json_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rosetta blocks written as JSON text and parsed again."""
    texts = ledger.rosetta_blocks(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    transactions = rosetta_transactions(parse_blocks(texts, family="rosetta"))
    return transactions.select(
        "transaction_hash", "transaction_index", "operation_count", "metadata", RANGE_BY
    )


# --- events and streamed tables ----------------------------------------------


@query
def resolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir), ledger.evm_headers(spark, sf_dir)
    )
    return resolved.select(
        "event.sequence_num",
        F.col("header.number").alias("number"),
        F.col("header.hash").alias("hash"),
        F.col("header.miner").alias("miner"),
    )


@query
def missing_event_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose block is missing while only filled orders have landed."""
    landed = ledger.evm_headers(spark, sf_dir).where(F.col("status") == "F")
    missing = missing_blocks(ledger.chain_events(spark, sf_dir), landed)
    return missing.withColumn("type", F.coalesce("type", F.lit("UNKNOWN")))


@query
def missing_event_blocks_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the plan for events that are too many to be broadcast."""
    landed = ledger.evm_headers(spark, sf_dir).where(F.col("status") == "F")
    events = ledger.chain_events(spark, sf_dir)
    stats = replace(event_stats(events), bytes=BROADCAST_BYTES + 1)
    missing = missing_blocks(events, landed, stats=stats)
    return missing.withColumn("type", F.coalesce("type", F.lit("UNKNOWN")))


@query
def evm_streamed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events meet transactions whose columns are built: no whole block is shuffled."""
    blocks = ledger.evm_blocks(spark, sf_dir)
    shown = _flat_transactions(evm_transactions(blocks, keyed=True), *BLOCK_KEYS).drop(PARTITION_BY, RANGE_BY)
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir),
        shown,
        height="height",
        block_hash="hash",
        headers=ledger.evm_split_headers(spark, sf_dir),
    )
    columns = [name for name in shown.columns if name not in BLOCK_KEYS]
    table = streamed(resolved, columns, partition_by_size=PARTITION_SIZE)
    return table.select("_sequence_number", "_event_type", *columns, *_layout())


@query
def evm_streamed_split_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events meet line items in the split layout: no block row is ever built."""
    headers = ledger.evm_split_headers(spark, sf_dir)
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir),
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "index", "value"]),
        height="height",
        block_hash="hash",
        headers=headers,
    )
    streamed = evm_split_transactions(
        resolved,
        headers,
        columns=["transaction_hash", "transaction_index", "value"],
        partition_by_size=PARTITION_SIZE,
    )
    return streamed.withColumn("value", _digits("value"))


@query
def evm_streamed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir), ledger.evm_headers(spark, sf_dir)
    )
    return _flat_blocks(
        evm_blocks(resolved, partition_by_size=PARTITION_SIZE), "_sequence_number", "_event_type"
    )


@query
def evm_raw_streamed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns, and what the serialised transaction says when read again."""
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir), ledger.evm_blocks(spark, sf_dir)
    )
    raw = evm_raw_transactions(resolved, partition_by_size=PARTITION_SIZE)
    again = F.from_json(
        F.col("transaction_data").cast("string"), split_transactions("evm")["transaction"].dataType
    )
    return raw.withColumn("tx", again).select(
        "_sequence_number",
        "_event_type",
        "transaction_hash",
        "transaction_index",
        "block_hash",
        "block_number",
        "block_timestamp",
        F.col("tx.hash").alias("payload_hash"),
        F.col("tx.nonce").alias("payload_nonce"),
        F.size("tx.flattened_traces").cast("bigint").alias("payload_traces"),
        *_layout(),
    )


@query
def rosetta_raw_streamed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir),
        ledger.rosetta_blocks(spark, sf_dir),
        family="rosetta",
    )
    raw = rosetta_raw_transactions(resolved, partition_by_size=PARTITION_SIZE)
    again = F.from_json(
        F.col("transaction_data").cast("string"),
        split_transactions("rosetta")["transaction"].dataType,
    )
    return raw.withColumn("tx", again).select(
        "_sequence_number",
        "_event_type",
        F.col("block_info.block_identifier.index").alias("number"),
        F.col("block_info.block_identifier.hash").alias("hash"),
        F.col("block_info.parent_identifier.index").alias("parent_number"),
        F.col("block_info.parent_identifier.hash").alias("parent_hash"),
        F.col("block_info.timestamp").alias("timestamp"),
        "transaction_index",
        F.col("tx.transaction_identifier.hash").alias("payload_hash"),
        F.size("tx.operations").cast("bigint").alias("payload_operations"),
        *_layout(),
    )


@query
def reorganised_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each block was added and removed: removals pass like additions."""
    resolved = resolve_events(
        ledger.chain_events(spark, sf_dir), ledger.evm_headers(spark, sf_dir)
    )
    streamed = evm_blocks(resolved, columns=["number"])
    kind = F.col("_event_type")
    return streamed.groupBy("number").agg(
        F.count(F.when(kind == "BLOCK_ADDED", 1)).alias("added"),
        F.count(F.when(kind == "BLOCK_REMOVED", 1)).alias("removed"),
        F.count(F.when(kind == "UNKNOWN", 1)).alias("unknown"),
    )


def _ledger(spark: SparkSession, sf_dir: str, chain: str = "ethereum") -> Ledger:
    blocks = {
        "evm": ledger.evm_blocks(spark, sf_dir),
        "rosetta": ledger.rosetta_blocks(spark, sf_dir),
    }
    if chain == "bitcoin":
        blocks = {"bitcoin": ledger.bitcoin_blocks(spark, sf_dir)}
    return Ledger(
        chain,
        "mainnet",
        blocks,
        ledger.chain_events(spark, sf_dir),
        ledger.METADATA,
    )


@query
def batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch query without bounds: from the chain's start to its tip."""
    asked = BatchQuery("transactions", partition_by_size=PARTITION_SIZE)
    result = _ledger(spark, sf_dir).batch(asked, columns=["transaction_hash", "value"])
    return result.withColumn("value", _digits("value"))


@query
def stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream query without bounds: the whole event log."""
    asked = StreamQuery("streamed_blocks", partition_by_size=PARTITION_SIZE)
    result = _ledger(spark, sf_dir).stream(
        asked, columns=["hash", "transaction_count", "total_difficulty"]
    )
    return result.withColumn("total_difficulty", _digits("total_difficulty"))


_STREAMED = TableKey("streamed_transactions")
_STREAM_COLUMNS = ["transaction_hash", "transaction_index", "value"]


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log replayed as a batch, in its table's row form."""
    streamed = replay(
        "ethereum",
        _STREAMED,
        ledger.chain_events(spark, sf_dir),
        ledger.evm_blocks(spark, sf_dir, ["hash", "index", "value"]),
        columns=_STREAM_COLUMNS,
        partition_by_size=PARTITION_SIZE,
    )
    return streamed.withColumn("value", _digits("value"))


def _store_blocks(spark: SparkSession, sf_dir: str, root: str) -> None:
    # Members that are not written are read as unset; these tables ask for none of them.
    ledger.evm_blocks(spark, sf_dir, ["hash", "index", "value"]).select(
        "tag", F.struct("header.number", "header.hash").alias("header"), "transactions"
    ).write.parquet(f"{root}/blocks")


def _land(events: DataFrame, path: str, least: int = 1) -> None:
    """Add events to those that a stream finds, in files of about ``LANDED`` at most: one
    task writes a file, and one may have to read it."""
    files = max(least, -(-events.count() // LANDED))
    dealt = events.coalesce(1) if files == 1 else events.repartitionByRange(files, "sequence_num")
    dealt.write.mode("append").parquet(path)


def _catch_up(spark: SparkSession, root: str, checkpoint: str, start: int) -> None:
    """Stream the stored events from ``start`` on into the stored table."""
    running = (
        stream_table(
            "ethereum",
            _STREAMED,
            stream_events(spark, f"{root}/events", start=start, max_files=2),
            lambda session: read_blocks(session, f"{root}/blocks"),
            f"{root}/table",
            f"{root}/{checkpoint}",
            columns=_STREAM_COLUMNS,
            partition_by_size=PARTITION_SIZE,
        )
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def _streamed_values(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).select(
        "_sequence_number",
        "_event_type",
        "transaction_hash",
        "transaction_index",
        _digits("value").alias("value"),
        F.col(PARTITION_BY).cast("bigint").alias(PARTITION_BY),
        RANGE_BY,
    )


@query
def stream_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from Structured Streaming: events land as files, a query catches up
    with them, and its output is read back."""
    root = demo_dir(spark, "stream-run")
    _land(ledger.chain_events(spark, sf_dir), f"{root}/events", least=4)
    _store_blocks(spark, sf_dir, root)
    _catch_up(spark, root, "checkpoint", 0)
    return _streamed_values(spark, f"{root}/table")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stream that resumes its checkpoint, and then one with a new
    checkpoint that starts where the first one ended."""
    root = demo_dir(spark, "stream-restart")
    events = ledger.chain_events(spark, sf_dir)
    low, high = ranges.event_bounds(events)
    third = (high - low) // 3
    _store_blocks(spark, sf_dir, root)
    for part, checkpoint, start in ((0, "first", low), (1, "first", low), (2, "second", low + 2 * third)):
        end = high + 1 if part == 2 else low + (part + 1) * third
        _land(scan_events(events, low + part * third, end), f"{root}/events")
        _catch_up(spark, root, checkpoint, start)
    return _streamed_values(spark, f"{root}/table")


@query
def stream_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same written slice by slice, a part of it twice."""
    root = demo_dir(spark, "backfill")
    events = ledger.chain_events(spark, sf_dir)
    blocks = ledger.evm_blocks(spark, sf_dir, ["hash", "index", "value"])
    low, high = ranges.event_bounds(events)
    size = (high - low) // 3 + 1
    for end in (0, (low + high) // 2 + 1):
        backfill(
            "ethereum",
            _STREAMED,
            events,
            blocks,
            f"{root}/table",
            end=end,
            events_per_slice=size,
            columns=_STREAM_COLUMNS,
            partition_by_size=PARTITION_SIZE,
        )
    return _streamed_values(spark, f"{root}/table")


# --- sink, catalog, metrics --------------------------------------------------


def _stored_transactions(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """The transactions table written by its layout: its path and schema."""
    path = demo_dir(spark, "sink") + "/transactions"
    table = evm_split_transactions(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "index", "value"]),
        ledger.evm_split_headers(spark, sf_dir),
        columns=["transaction_hash", "transaction_index", "value"],
        partition_by_size=PARTITION_SIZE,
    )
    write_table(table, path)
    return path, table.schema


@query
def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions table written and read back."""
    path, schema = _stored_transactions(spark, sf_dir)
    return read_table(spark, path, schema).withColumn("value", _digits("value"))


@query
def sink_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of the written transactions table, its directories pruned."""
    path, schema = _stored_transactions(spark, sf_dir)
    end = ranges.tip(_heights(spark, sf_dir), ledger.METADATA, height="height") + 1
    written = read_table(
        spark, path, schema, start=end // 2, end=end, partition_by_size=PARTITION_SIZE
    )
    return written.withColumn("value", _digits("value"))


def _streamed_table(source: Ledger, key: TableKey, stats: EventStats, check: bool) -> DataFrame:
    """A streamed table's rows. Transactions are built before events are joined: only the
    keys of their blocks are shuffled for it, no block with all that is in it."""
    family = block_family(source.chain, key)
    blocks = source.blocks[family]
    if key.table != "streamed_transactions":
        resolved = resolve_events(source.events, blocks, family=family, stats=stats, check=check)
        return build(source.chain, key, resolved)
    resolved = resolve_events(
        source.events,
        build(source.chain, key, blocks, keyed=True).select(*BLOCK_KEYS),
        height="height",
        block_hash="hash",
        headers=blocks.select(*key_columns(family)),
        stats=stats,
        check=check,
    )
    return streamed(resolved, ())


@query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of two chains: its key, its width and how many rows it has here."""
    results = []
    for chain in ("ethereum", "bitcoin"):
        source = _ledger(spark, sf_dir, chain)
        keys = source.tables()
        stats = event_stats(source.events)
        checked, counts = set(), []
        for key in keys:
            family = block_family(chain, key)
            if key.streamed:
                table = _streamed_table(source, key, stats, check=family not in checked)
                checked.add(family)
            else:
                table = build(chain, key, source.blocks[family])
            counts.append(table.select(F.lit(str(key)).alias("table_key")))
        rows = reduce(DataFrame.union, counts).groupBy("table_key").agg(
            F.count(F.lit(1)).alias("rows")
        )
        listing = list_tables(spark, chain, "mainnet")
        results.append(
            listing.join(rows, "table_key", "left").select(
                F.lit(chain).alias("chain"), "table_key", "columns", "rows"
            )
        )
    return reduce(DataFrame.union, results)


@query
def blocks_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks counted while their transactions are written to nowhere."""
    seen = Observation()
    end = ranges.tip(_heights(spark, sf_dir), ChainMetadata(), height="height") + 1
    asked = BatchQuery("transactions", end_height=end)
    narrow = _ledger(spark, sf_dir).batch(asked, seen=seen, columns=["transaction_hash"])
    narrow.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get[BLOCKS_PROCESSED],)], "blocks_processed BIGINT")


# --- stores, and tables written slice by slice -------------------------------


@query
def chain_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain's facts read from a table of them: here the first order, and how many
    orders a customer has at most."""
    placed = ledger.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("first"), F.count(F.lit(1)).alias("orders")
    )
    facts = read_metadata(
        placed.agg(
            F.min("first").alias("block_start_height"), F.max("orders").alias("irreversible_distance")
        )
    )
    tip = ranges.tip(_heights(spark, sf_dir), facts, height="height")
    return spark.createDataFrame(
        [(facts.block_start_height, facts.irreversible_distance, tip)],
        "block_start_height BIGINT, irreversible_distance BIGINT, tip_height BIGINT",
    )


@query
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from each named position on, and from a number."""
    events = ledger.chain_events(spark, sf_dir)
    first, last = ranges.event_bounds(events)
    counts = []
    for position in ("EARLIEST", "LATEST", (first + last) // 2):
        begin = start_position(events, position)
        counts.append(
            scan_events(events, begin, last + 1).agg(
                F.lit(str(position) if isinstance(position, str) else "MIDDLE").alias("position"),
                F.min("sequence_num").alias("first_sequence"),
                F.count(F.lit(1)).alias("events"),
            )
        )
    return reduce(DataFrame.union, counts)


@query
def required_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and transactions by status, each through the check of what it must have."""
    headers = ledger.evm_headers(spark, sf_dir)
    checked = require_body(headers, "evm").where(
        scalars.require(F.col("header.hash").isNull(), "hash is required")
    )
    return checked.groupBy("status").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("header.number").alias("numbers")
    )


@query
def height_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line item, as whole gaps in the heights of the line items."""
    end = ranges.tip(_heights(spark, sf_dir), ledger.METADATA, height="height")
    lines = ledger.lines(spark, sf_dir).select(F.col("k").alias("height"))
    return ranges.height_gaps(lines, 0, end, height="height")


@query
def doubled_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with several line items, as heights stored more than once."""
    end = ranges.tip(_heights(spark, sf_dir), ledger.METADATA, height="height")
    lines = ledger.lines(spark, sf_dir).select(F.col("k").alias("height"))
    return ranges.doubled_heights(lines, 0, end, height="height")


@query
def event_store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log in a directory for every few sequences, replayed from there."""
    path = demo_dir(spark, "event-store") + "/events"
    write_event_store(ledger.chain_events(spark, sf_dir), path, 2 * PARTITION_SIZE)
    blocks = {"evm": ledger.evm_blocks(spark, sf_dir, ["hash", "index", "value"])}
    stored = Ledger("ethereum", "mainnet", blocks, read_event_store(spark, path), ledger.METADATA)
    asked = StreamQuery(
        "streamed_transactions",
        stored.stream_earliest(),
        stored.stream_tip() + 1,
        partition_by_size=PARTITION_SIZE,
    )
    return stored.stream(asked, columns=_STREAM_COLUMNS).withColumn("value", _digits("value"))


@query
def event_store_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the stored log, its directories pruned."""
    path = demo_dir(spark, "event-range") + "/events"
    write_event_store(ledger.chain_events(spark, sf_dir), path, PARTITION_SIZE)
    stored = read_event_store(spark, path)
    first, last = ranges.event_bounds(stored)
    half = scan_events(stored, (first + last) // 2, last + 1)
    name = scalars.enum_name(F.col("type"), scalars.EVENT_TYPES).alias("type")
    return half.select("sequence_num", name, "block.*")


def _bucketed(spark: SparkSession, sf_dir: str) -> BlockStore:
    """Blocks stored in buckets by key, as a table of the session's catalog."""
    path = demo_dir(spark, "bucketed") + "/blocks"
    # Blocks with the members that are asked for below; the others are read as unset.
    blocks = ledger.evm_blocks(spark, sf_dir, ["hash", "index", "value"])
    table = "demo_blocks_" + path.split("-")[-1].split("/")[0]
    bucket_size, buckets = store_sizes(_heights(spark, sf_dir), 50 * PARTITION_SIZE, height="height")
    write_block_store(blocks, table, path, bucket_size=bucket_size, buckets=buckets)
    return read_block_store(spark, table, bucket_size)


@query
def bucketed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events too many to be broadcast meet blocks that stay where they lie."""
    events, blocks = ledger.chain_events(spark, sf_dir), _bucketed(spark, sf_dir)
    stats = replace(event_stats(events), bytes=BROADCAST_BYTES + 1)
    resolved = resolve_events(events, blocks, stats=stats)
    streamed = evm_transactions(resolved, columns=_STREAM_COLUMNS, partition_by_size=PARTITION_SIZE)
    return streamed.withColumn("value", _digits("value"))


def _split_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    store = SplitStore(
        ledger.evm_split_transactions(spark, sf_dir, ["hash", "index", "value"]),
        ledger.evm_split_headers(spark, sf_dir),
    )
    return Ledger(
        "ethereum", "mainnet", {"evm": store}, ledger.chain_events(spark, sf_dir), ledger.METADATA
    )


_SPLIT_COLUMNS = ["transaction_hash", "transaction_index", "value", "block"]


@query
def ledger_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch query on a split store: line items beside their order's header."""
    asked = BatchQuery("transactions", partition_by_size=PARTITION_SIZE)
    result = _split_ledger(spark, sf_dir).batch(asked, columns=_SPLIT_COLUMNS)
    return result.select(
        "transaction_hash",
        "transaction_index",
        _digits("value").alias("value"),
        F.col("block.miner").alias("miner"),
        *_layout(),
    )


@query
def ledger_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream query on a split store."""
    asked = StreamQuery("streamed_transactions", partition_by_size=PARTITION_SIZE)
    result = _split_ledger(spark, sf_dir).stream(asked, columns=_STREAM_COLUMNS)
    return result.withColumn("value", _digits("value"))


@query
def ledger_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch query whose blocks are cut into pieces and dealt out before they are unnested."""
    asked = BatchQuery("transactions", partition_by_size=PARTITION_SIZE)
    result = _ledger(spark, sf_dir).batch(asked, spread=2, columns=["transaction_hash", "value"])
    return result.withColumn("value", _digits("value"))


@query
def batch_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch table written in slices: half of it, and then the whole, which goes on from there."""
    path = demo_dir(spark, "batch-backfill") + "/table"
    source = _split_ledger(spark, sf_dir)
    tip = source.tip()
    asked = BatchQuery(
        "transactions", partition_by_size=PARTITION_SIZE, blocks_per_partition=tip // 4 + 1
    )
    columns = ["transaction_hash", "transaction_index", "value"]
    source.backfill(replace(asked, end_height=tip // 2), path, columns=columns)
    source.backfill(asked, path, columns=columns)
    written = read_slices(spark, path)
    return written.withColumns(
        {"value": _digits("value"), PARTITION_BY: F.col(PARTITION_BY).cast("bigint")}
    )


@query
def backfill_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and events that two backfills took, one of them run twice: by table."""
    root, source = demo_dir(spark, "progress"), _ledger(spark, sf_dir)
    rows = []
    for asked in (
        BatchQuery("blocks", blocks_per_partition=source.tip() // 3 + 1),
        StreamQuery("streamed_blocks", events_per_partition=source.stream_tip() // 2 + 1),
    ):
        path = f"{root}/{asked.table}"
        for _ in range(2):
            source.backfill(asked, path, columns=["hash"])
        rows.append((asked.table, processed(spark, path)))
    return spark.createDataFrame(rows, "table_name STRING, blocks_processed BIGINT")


def _small_batches(spark: SparkSession, root: str, checkpoint: str, start: int, size: int) -> None:
    """Stream the stored events into the stored table, ``size`` of them at a time."""
    stream_table(
        "ethereum",
        _STREAMED,
        stream_events(spark, f"{root}/events", start=start),
        lambda session: read_blocks(session, f"{root}/blocks"),
        f"{root}/table",
        f"{root}/{checkpoint}",
        columns=_STREAM_COLUMNS,
        partition_by_size=PARTITION_SIZE,
        events_per_part=size,
    ).trigger(availableNow=True).start().awaitTermination()


def _each_event_once(spark: SparkSession, path: str) -> DataFrame:
    table = read_streamed(spark, path).select("_sequence_number", "_event_type", *_STREAM_COLUMNS, *_layout())
    return table.withColumns(
        {"value": _digits("value"), PARTITION_BY: F.col(PARTITION_BY).cast("bigint")}
    )


@query
def stream_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one micro-batch, up to ``LANDED`` in one file, streamed in parts of a
    quarter of the log."""
    root = demo_dir(spark, "small-batches")
    events = ledger.chain_events(spark, sf_dir)
    _store_blocks(spark, sf_dir, root)
    _land(events, f"{root}/events")
    low, high = ranges.event_bounds(events)
    _small_batches(spark, root, "checkpoint", low, (high - low) // 4 + 1)
    return _each_event_once(spark, f"{root}/table")


@query
def stream_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own: the second begins before the first's end."""
    root = demo_dir(spark, "overlap")
    events = ledger.chain_events(spark, sf_dir)
    low, high = ranges.event_bounds(events)
    third = (high - low) // 3
    _store_blocks(spark, sf_dir, root)
    _land(scan_events(events, low, low + 2 * third), f"{root}/events")
    _catch_up(spark, root, "first", low)
    _land(scan_events(events, low + 2 * third, high + 1), f"{root}/events")
    _catch_up(spark, root, "second", low + third)
    return _each_event_once(spark, f"{root}/table")


@query
def catalog_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two written tables as tables of the catalog: their rows by its statistics, and the
    rows of the later directories by SQL."""
    root = demo_dir(spark, "catalog")
    source, prefix = _ledger(spark, sf_dir), "demo_" + root.split("-")[-1] + "_"
    for table in ("transactions", "blocks"):
        asked = BatchQuery(table, partition_by_size=PARTITION_SIZE)
        write_table(source.batch(asked), table_path(root, TableKey(table)))
    created = create_tables(spark, root, "ethereum", "mainnet", prefix=prefix)
    half = source.tip() // 2 // PARTITION_SIZE * PARTITION_SIZE
    later = [
        spark.table(name).where(F.col(PARTITION_BY) >= half).agg(
            F.lit(name.rpartition(prefix)[2]).alias("table"), F.count(F.lit(1)).alias("later_rows")
        )
        for name in created
    ]
    listing = list_tables(spark, "ethereum", "mainnet", database="default", prefix=prefix)
    known = listing.where("total_records >= 0").select("table", F.col("total_records").alias("rows"))
    return known.join(reduce(DataFrame.union, later), "table")
