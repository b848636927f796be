"""Orders and line items as parsed blocks, transactions and chain events.

An order is a block. In the nested layout its transactions are the postings that
its state implies: a payment, a settlement once it is filled, a surcharge if it
is urgent; a pending order is an empty block. In the split layout its
transactions are its line items. An event of the event table adds or removes a
block.

Every mapping works row by row: no group is ever collected, however many line
items an order has, so nothing is shuffled before the operators under test.
Some members are left unset or hold text that is no number, on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.functions.scalars import epoch_seconds
from blockloom.sources.metadata import ChainMetadata

METADATA = ChainMetadata(block_start_height=0, irreversible_distance=100)
PAYMENT, SETTLEMENT, SURCHARGE = 0, 1, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _struct(members: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in members.items()])


def _text(*parts: Column | str | int) -> Column:
    return F.concat(
        *[F.lit(str(p)) if not isinstance(p, Column) else p.cast("string") for p in parts]
    )


def _long(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _repeat(count: Column, most: int, build: Callable[[Column], Column]) -> Column:
    """``count`` elements built from 0, 1, ...; an empty list for none.

    Written out element by element: unlike a lambda this is compiled. A count above
    ``most`` fails the job.
    """
    items = F.array_compact(F.array(*[F.when(count > i, build(_long(i))) for i in range(most)]))
    return F.when(count > most, F.raise_error(F.lit(f"more than {most} elements"))).otherwise(items)


def _seconds(df: DataFrame, column: str) -> Column:
    ntz = isinstance(df.schema[column].dataType, T.TimestampNTZType)
    return epoch_seconds(F.col(column), ntz=ntz)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return raw.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        status.alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        _seconds(raw, "o_orderdate").alias("seconds"),
    )


def _postings(build: Callable[[Column, Column], Column]) -> Column:
    """The postings of an order: ``build`` gets the kind and the position in the block."""
    paid, filled = F.col("status") != "P", F.col("status") == "F"
    urgent = F.col("priority") == "1-URGENT"
    return F.array_compact(
        F.array(
            F.when(paid, build(F.lit(PAYMENT), _long(0))),
            F.when(filled, build(F.lit(SETTLEMENT), _long(1))),
            F.when(paid & urgent, build(F.lit(SURCHARGE), F.when(filled, _long(2)).otherwise(_long(1)))),
        )
    )


def _posting_count() -> Column:
    filled = (F.col("status") == "F").cast("bigint")
    urgent = (F.col("priority") == "1-URGENT").cast("bigint")
    return F.when(F.col("status") == "P", _long(0)).otherwise(filled + urgent + 1)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem")
    return raw.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        _seconds(raw, "l_shipdate").alias("seconds"),
    )


def line_amount() -> Column:
    """Amount of a line item as text, by line number: plain, empty, hexadecimal, with
    32 more digits, negative, with a plus sign, with leading zeros."""
    line, cents = F.col("line"), F.col("cents")
    return (
        F.when(line == 2, F.lit(""))
        .when(line == 3, _text("0x", cents))
        .when(line == 4, _text(cents, "0" * 32))
        .when(line == 5, _text("-", cents))
        .when(line == 6, _text("+", cents))
        .when(line == 7, _text("000", cents))
        .otherwise(_text(cents))
    )


# --- EVM ---------------------------------------------------------------------


def _named(df: DataFrame, values: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Columns of their own for values that are used many times over."""
    named = {name: F.col(f"tx_{name}") for name in values}
    return df.withColumns({f"tx_{name}": value for name, value in values.items()}), named


def _members(transaction: dict[str, Column], wanted: Iterable[str] | None) -> Column:
    """A transaction with only some members, as a scan would read it."""
    if wanted is None:
        return _struct(transaction)
    return _struct({name: transaction[name] for name in wanted})


def _evm_place(tx: dict[str, Column]) -> dict[str, Column]:
    return {
        "transaction_hash": tx["hash"],
        "transaction_index": tx["index"],
        "block_hash": tx["block_hash"],
        "block_number": tx["block_number"],
    }


def _evm_log(tx: dict[str, Column], i: Column, topics: Column) -> Column:
    return _struct(
        {
            **_evm_place(tx),
            "log_index": tx["index"] * 10 + i,
            "address": tx["to"],
            "data": _text("d", i),
            "topics": topics,
            "removed": F.when(i == 0, F.lit(False)).otherwise(F.lit(True)),
        }
    )


def _evm_trace(tx: dict[str, Column], i: Column) -> Column:
    return _struct(
        {
            **_evm_place(tx),
            "from": tx["from"],
            "to": tx["to"],
            "value": F.when(i == 0, tx["value"]).otherwise(F.lit("-0x1")),
            "input": tx["input"],
            "output": _null("string"),
            "type": F.lit("CALL"),
            "trace_type": F.when(i == 0, F.lit("call")).otherwise(F.lit("create")),
            "call_type": F.when(i == 0, F.lit("call")),
            "gas": tx["gas"] - i,
            "gas_used": tx["gas"] - i * 2,
            "subtraces": 1 - i,
            "trace_address": F.when(i == 0, F.array().cast("array<bigint>")).otherwise(
                F.array(_long(0), i)
            ),
            "error": F.when(i == 0, F.lit("out of gas")),
            "status": i,
            "trace_id": _text("call_", tx["hash"], "_", i),
        }
    )


def _evm_transaction(
    tx: dict[str, Column],
    *,
    log_count: Column,
    topics: Callable[[Column], Column],
    trace_count: Column,
    on_l1: Column,
) -> dict[str, Column]:
    receipt = {
        **_evm_place(tx),
        "from": tx["from"],
        "to": tx["to"],
        "cumulative_gas_used": tx["gas"] * 2,
        "gas_used": tx["gas"],
        "contract_address": F.when(tx["to"].isNull(), _text("new-", tx["hash"])),
        "logs": _repeat(log_count, 2, lambda i: _evm_log(tx, i, topics(i))),
        "logs_bloom": F.lit("0x00"),
        "root": _null("string"),
        "type": tx["type"],
        "status": F.when(tx["type"] != 1, _long(1)),
        "effective_gas_price": F.when(tx["type"] != 2, tx["gas_price"]),
        "l1_fee_info": F.when(
            on_l1,
            _struct(
                {
                    "l1_gas_used": tx["gas"] + 1,
                    "l1_gas_price": tx["gas_price"] + 2,
                    "l1_fee": tx["gas"] + 3,
                    "l1_fee_scalar": F.lit("0.684"),
                }
            ),
        ),
    }
    return {
        **tx,
        "priority_fee_per_gas": _null("bigint"),
        "receipt": _struct(receipt),
        "flattened_traces": _repeat(trace_count, 2, lambda i: _evm_trace(tx, i)),
    }


def _evm_posting(kind: Column, i: Column, members: Iterable[str] | None) -> Column:
    k, cust, cents = F.col("k"), F.col("cust"), F.col("cents")
    tx = {
        "hash": _text("t", k, "-", kind),
        "index": _long(i),
        "block_hash": _text("b", k),
        "block_number": k,
        "block_timestamp": F.col("seconds"),
        "from": _text("c", cust),
        "to": F.when(kind != SURCHARGE, _text("s", kind)),
        "nonce": cust,
        "value": F.when(kind == PAYMENT, _text(cents))
        .when(kind == SURCHARGE, F.lit("1" + "0" * 38))
        .when(F.col("priority") == "2-HIGH", F.lit("0x3"))
        .otherwise(F.lit("")),
        "gas": _long(21000) + kind,
        "gas_price": cust + 1,
        "input": _text("0x", kind),
        "type": _long(kind),
        "max_fee_per_gas": F.when(kind != PAYMENT, cents),
        "max_priority_fee_per_gas": F.when(kind == SURCHARGE, _long(5)),
    }
    transaction = _evm_transaction(
        tx,
        log_count=F.when(kind == PAYMENT, 2).otherwise(0),
        topics=lambda n: F.when(n == 0, F.array(_text("c", cust), F.lit("Transfer"))).otherwise(
            F.array().cast("array<string>")
        ),
        trace_count=2 - kind,
        on_l1=kind != SETTLEMENT,
    )
    return _members(transaction, members)


def _evm_header() -> dict[str, Column]:
    k, cust, cents = F.col("k"), F.col("cust"), F.col("cents")
    return {
        "hash": _text("b", k),
        "parent_hash": F.when(k > 0, _text("b", k - 1)),
        "number": k,
        "timestamp": F.col("seconds"),
        "miner": _text("c", cust),
        "difficulty": cust * 1000 + 7,
        "gas_limit": _long(30_000_000),
        "gas_used": cents % 30_000_000,
        "base_fee_per_gas": F.when(F.col("status") != "O", cust),
    }


def _evm_uncle(i: Column) -> Column:
    header = _evm_header()
    header["hash"] = _text("b", F.col("k"), "u", i)
    header["number"] = F.greatest(F.col("k") - 1, _long(0))
    header["timestamp"] = F.col("seconds") - 12 * (i + 1)
    header["base_fee_per_gas"] = _null("bigint")
    return _struct(header)


def evm_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tag, header, uncles, k, cust, ...): headers of all orders, without transactions."""
    k, cust = F.col("k"), F.col("cust")
    uncles = cust % 3
    header = {
        **_evm_header(),
        "nonce": _text("n", k),
        "sha3_uncles": _null("string"),
        "logs_bloom": F.lit("0x00"),
        "transactions_root": _text("tr", k),
        "state_root": F.col("status"),
        "receipts_root": F.col("priority"),
        "total_difficulty": F.when(F.col("status") == "P", F.lit("")).otherwise(
            _text(F.col("cents"), "0" * 20)
        ),
        "size": cust + 500,
        "extra_data": _text("x", F.col("priority")),
        "transactions": _postings(lambda kind, i: _text("t", k, "-", kind)),
        "uncles": _repeat(uncles, 2, lambda i: _text("b", k, "u", i)),
        "withdrawals": _repeat(
            k % 4,
            3,
            lambda i: _struct(
                {
                    "index": k * 10 + i,
                    "validator_index": cust + i,
                    "address": _text("c", cust),
                    "amount": F.when(i > 0, i * 100),
                }
            ),
        ),
        "withdrawals_root": F.when(k % 4 > 0, _text("w", k)),
    }
    return orders(spark, sf_dir).select(
        _long(1).alias("tag"),
        _struct(header).alias("header"),
        _repeat(uncles, 2, _evm_uncle).alias("uncles"),
        "*",
    )


def evm_blocks(
    spark: SparkSession, sf_dir: str, members: Iterable[str] | None = None
) -> DataFrame:
    """Nested layout: one row per order with its postings (or some members of them)."""
    return evm_headers(spark, sf_dir).select(
        "tag",
        "header",
        "uncles",
        _postings(lambda kind, i: _evm_posting(kind, i, members)).alias("transactions"),
    )


def evm_split_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split layout: (tag, height, hash, header) of all orders."""
    return evm_headers(spark, sf_dir).select(
        "tag", F.col("k").alias("height"), _text("b", F.col("k")).alias("hash"), "header"
    )


def evm_split_transactions(
    spark: SparkSession, sf_dir: str, members: Iterable[str] | None = None
) -> DataFrame:
    """Split layout: (tag, height, hash, transaction) of all line items."""
    k, part, supp, flag = F.col("k"), F.col("part"), F.col("supp"), F.col("flag")
    tx = {
        "hash": line_hash(),
        "index": F.col("line") - 1,
        "block_hash": _text("b", k),
        "block_number": k,
        "block_timestamp": F.col("seconds"),
        "from": _text("p", part),
        "to": F.when(F.col("line") != 7, _text("s", supp)),
        "nonce": part,
        "value": line_amount(),
        "gas": F.col("quantity") + 21000,
        "gas_price": supp + 1,
        "input": _text(flag, F.col("state")),
        "type": F.col("line") % 3,
        "max_fee_per_gas": F.when(flag != "N", part),
        "max_priority_fee_per_gas": F.when(flag == "R", supp),
    }
    rows, tx = _named(lines(spark, sf_dir), tx)
    transaction = _evm_transaction(
        tx,
        log_count=F.when(flag == "R", 1).when(flag == "A", 2).otherwise(0),
        topics=lambda n: F.when(
            flag == "R", F.array(F.col("state"), _text("s", supp))
        ).otherwise(F.array().cast("array<string>")),
        trace_count=F.when(F.col("state") == "O", 2).otherwise(0),
        on_l1=F.col("state") == "O",
    )
    return rows.select(
        _long(1).alias("tag"),
        k.alias("height"),
        tx["block_hash"].alias("hash"),
        _members(transaction, members).alias("transaction"),
    )


def line_hash() -> Column:
    return _text(
        "t", F.col("k"), "-", F.col("line"), "-", F.col("part"), "-", F.col("supp")
    )


# --- Bitcoin -----------------------------------------------------------------


def _bitcoin_header(transactions: Column) -> Column:
    k, cust = F.col("k"), F.col("cust")
    return _struct(
        {
            "hash": _text("b", k),
            "size": cust + 900,
            "stripped_size": cust + 800,
            "weight": cust * 4,
            "height": k,
            "version": _long(2),
            "merkle_root": _text("m", k),
            "time": F.col("seconds"),
            "nonce": F.col("cents"),
            "bits": F.lit("1d00ffff"),
            "difficulty": _text(cust, ".5"),
            "chain_work": _null("string"),
            "number_of_transactions": transactions,
            "previous_block_hash": F.when(k > 0, _text("b", k - 1)),
            "next_block_hash": _text("b", k + 1),
        }
    )


def _bitcoin_transaction(
    name: Column, index: Column, mints: Column, amount: Column, owner: Column
) -> dict[str, Column]:
    """A minting transaction has one unsigned input; others spend two outputs."""
    inputs = F.when(mints, 1).otherwise(2)
    outputs = F.when(mints, 1).otherwise(index % 2 + 1)

    def spend(i: Column) -> Column:
        script = _struct({"assembly": _text("asm", i), "hex": _text("hex", i)})
        spent = _struct(
            {
                "script_public_key": _struct(
                    {"type": F.lit("pubkeyhash"), "address": _text("a", owner)}
                ),
                "value": amount + i,
            }
        )
        return _struct(
            {
                "minted": F.when(mints, _text("cb", name)),
                "transaction_id": F.when(~mints, _text("prev-", name)),
                "from_output_index": F.when(~mints, i),
                "script_signature": F.when(~mints, script),
                "sequence": _long(4294967295) - i,
                "transaction_input_witnesses": F.when(
                    i == 1, F.array(F.lit("w1"), _text("w", name))
                ).otherwise(F.array().cast("array<string>")),
                "from_output": F.when(~mints, spent),
            }
        )

    def pay(i: Column) -> Column:
        return _struct(
            {
                "index": i,
                "script_public_key": F.when(
                    i == 0,
                    _struct(
                        {
                            "assembly": F.lit("OP_DUP"),
                            "hex": F.lit("76"),
                            "type": F.lit("pubkeyhash"),
                            "address": _text("a", owner),
                        }
                    ),
                ),
                "value": amount - i,
            }
        )

    return {
            "transaction_id": name,
            "hash": _text("witness-", name),
            "size": amount % 1000,
            "virtual_size": amount % 900,
            "weight": amount % 4000,
            "version": _long(2),
            "lock_time": _long(0),
            "mints": mints,
            "index": index,
            "inputs": _repeat(inputs, 2, spend),
            "outputs": _repeat(outputs, 2, pay),
            "input_count": _long(inputs),
            "output_count": _long(outputs),
            "input_value": F.when(~mints, amount * 2 + 1),
            "output_value": amount,
            "fee": F.when(~mints, amount % 100),
        }


def bitcoin_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested layout: the first posting of an order is its minting transaction."""
    k = F.col("k")
    return orders(spark, sf_dir).select(
        _long(1).alias("tag"),
        _bitcoin_header(_posting_count()).alias("header"),
        _postings(
            lambda kind, i: _struct(
                _bitcoin_transaction(
                    _text("t", k, "-", kind), i, i == 0, F.col("cents"), F.col("cust")
                )
            )
        ).alias("transactions"),
    )


def bitcoin_split_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        _long(1).alias("tag"),
        F.col("k").alias("height"),
        _text("b", F.col("k")).alias("hash"),
        _bitcoin_header(_posting_count()).alias("header"),
    )


def bitcoin_split_transactions(
    spark: SparkSession, sf_dir: str, members: Iterable[str] | None = None
) -> DataFrame:
    """Split layout: line 1 of an order is a minting transaction."""
    line = F.col("line")
    rows, tx = _named(lines(spark, sf_dir), {"name": line_hash()})
    transaction = _bitcoin_transaction(
        tx["name"], line - 1, line == 1, F.col("cents"), F.col("supp")
    )
    return rows.select(
        _long(1).alias("tag"),
        F.col("k").alias("height"),
        _text("b", F.col("k")).alias("hash"),
        _members(transaction, members).alias("transaction"),
    )


# --- Rosetta -----------------------------------------------------------------


def _json_text(value: Column) -> Column:
    return _text('"', value, '"')


def _rosetta_operation(kind: Column, i: Column) -> Column:
    """A payment is debited and credited; a settlement has neither amount nor account; a
    surcharge creates and spends a coin, and its amount does not fit."""
    cents, cust = F.col("cents"), F.col("cust")
    amount = (
        F.when(kind == SURCHARGE, F.lit("9" * 39))
        .when(i == 0, _text("-", cents))
        .otherwise(_text(cents))
    )
    return _struct(
        {
            "operation_identifier": _struct({"index": i, "network_index": F.when(i > 0, i + 5)}),
            "related_operations": _repeat(
                i, 1, lambda n: _struct({"index": n, "network_index": _null("bigint")})
            ),
            "type": F.when(kind == SURCHARGE, F.lit("FEE")).otherwise(F.lit("TRANSFER")),
            "status": F.lit("SUCCESS"),
            "account": F.when(
                kind != SETTLEMENT,
                _struct(
                    {
                        "address": _text("c", cust),
                        "sub_account": F.when(i > 0, _struct({"address": _text("sub", cust)})),
                    }
                ),
            ),
            "amount": F.when(
                kind != SETTLEMENT,
                _struct(
                    {
                        "value": amount,
                        "currency": _struct({"symbol": F.lit("USD"), "decimals": _long(2)}),
                    }
                ),
            ),
            "coin_change": F.when(
                kind == SURCHARGE,
                _struct(
                    {
                        "coin_identifier": _struct({"identifier": _text("coin", i)}),
                        "coin_action": F.when(i > 0, F.lit("COIN_SPENT")).otherwise(
                            F.lit("COIN_CREATED")
                        ),
                    }
                ),
            ),
            "metadata": F.when(
                kind == PAYMENT,
                F.map_from_arrays(
                    F.array(F.lit("step"), F.lit("from")),
                    F.array(_text(i), _json_text(_text("c", cust))),
                ),
            ),
        }
    )


def _rosetta_posting(kind: Column) -> Column:
    k = F.col("k")
    return _struct(
        {
            "transaction_identifier": _struct({"hash": _text("t", k, "-", kind)}),
            "operations": _repeat(
                F.when(kind == SETTLEMENT, 1).otherwise(2), 2, lambda i: _rosetta_operation(kind, i)
            ),
            "related_transactions": _repeat(
                _long(kind),
                2,
                lambda i: _struct(
                    {
                        "transaction_identifier": _struct({"hash": _text("t", k, "-", i)}),
                        "direction": F.when(i > 0, F.lit("BACKWARD")),
                    }
                ),
            ),
            "metadata": F.when(
                kind == PAYMENT,
                F.map_from_arrays(
                    F.array(F.lit("status"), F.lit("cents"), F.lit("note")),
                    F.array(
                        _json_text(F.col("status")), _text(F.col("cents")), _null("string")
                    ),
                ),
            ).when(kind == SETTLEMENT, F.create_map().cast("map<string,string>")),
        }
    )


def order_metadata() -> Column:
    """Metadata of an order's block; blanks, markup and a missing value included."""
    k = F.col("k")
    return F.map_from_arrays(
        F.array(F.lit("priority"), F.lit('a"b'), F.lit("gone"), F.lit("Nested<1>")),
        F.array(
            _json_text(F.col("priority")),
            _text(k),
            _null("string"),
            _text('{ "k": ', k, ', "t": "x & y" }'),
        ),
    )


def rosetta_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return orders(spark, sf_dir).select(
        _long(1).alias("tag"),
        _struct({"index": k, "hash": _text("b", k)}).alias("block_identifier"),
        _struct(
            {
                "index": F.when(k > 0, k - 1),
                "hash": F.when(k > 0, _text("b", k - 1)),
            }
        ).alias("parent_block_identifier"),
        F.col("seconds").alias("timestamp"),
        F.when(F.col("status") != "O", order_metadata()).alias("metadata"),
        _postings(lambda kind, i: _rosetta_posting(kind)).alias("transactions"),
    )


# --- Events ------------------------------------------------------------------


def chain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error removes the block added before; a sign-up has no type."""
    kind, number = F.col("event_type"), F.col("event_id")
    removed = kind == "error"
    height = F.when(removed, F.greatest(number - 1, _long(0))).otherwise(number)
    return table(spark, sf_dir, "events").select(
        number.alias("sequence_num"),
        F.when(removed, F.lit("BLOCK_REMOVED"))
        .when(kind != "signup", F.lit("BLOCK_ADDED"))
        .alias("type"),
        _struct({"tag": _long(1), "height": height, "hash": _text("b", height)}).alias("block"),
    )
