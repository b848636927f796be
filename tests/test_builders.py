from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from blockloom import TableKey, build, register_builder
from blockloom.operators.bitcoin import bitcoin_blocks, bitcoin_split_transactions, bitcoin_transactions
from blockloom.operators.evm import evm_blocks, evm_split_transactions, evm_transactions
from blockloom.operators.rosetta import rosetta_blocks, rosetta_transactions
from blockloom.schemas.tables import table_schema
from tests.fixtures import blocks, evm_block, evm_transaction, rosetta_block


def rows(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def assert_schema(df, chain, key, u64="long"):
    wanted = table_schema(chain, key, u64)
    assert df.columns == wanted.names
    for got, field in zip(df.schema, wanted):
        assert got.dataType.simpleString() == field.dataType.simpleString(), field.name


def test_evm_transaction_defaults(spark):
    source = blocks(spark, [evm_block(7, [{"receipt": {}}])])
    df = evm_transactions(source, partition_by_size=5)
    assert_schema(df, "ethereum", TableKey("transactions"))
    assert rows(df) == [
        {
            "transaction_hash": "",
            "transaction_index": 0,
            "block_hash": "",
            "block_number": 0,
            "block_timestamp": 0,
            "from_address": "",
            "to_address": "",
            "nonce": 0,
            "value": Decimal(0),
            "value_string": "",
            "gas": 0,
            "gas_price": 0,
            "input": "",
            "transaction_type": 0,
            "max_fee_per_gas": 0,
            "max_priority_fee_per_gas": 0,
            "priority_fee_per_gas": 0,
            "block": {
                "hash": "b7",
                "parent_hash": "",
                "number": 7,
                "timestamp": 70,
                "miner": "",
                "difficulty": 0,
                "gas_limit": 0,
                "gas_used": 0,
                "base_fee_per_gas": 0,
            },
            "receipt": {
                "transaction_hash": "",
                "transaction_index": 0,
                "block_hash": "",
                "block_number": 0,
                "from_address": "",
                "to_address": "",
                "cumulative_gas_used": 0,
                "gas_used": 0,
                "contract_address": "",
                "logs": None,
                "logs_bloom": "",
                "root": "",
                "type": 0,
                "status": 0,
                "effective_gas_price": 0,
            },
            "traces": None,
            "_partition_by": 5,
            "_repartition_by_range": 7,
        }
    ]


def test_evm_traces_and_logs(spark):
    trace = {
        "transaction_hash": "t",
        "from": "a",
        "to": "b",
        "value": "0x3",
        "gas": 5,
        "gas_used": 4,
        "trace_address": [0, 2],
        "trace_id": "call_t",
    }
    log = {"log_index": 3, "address": "a", "topics": [], "removed": True}
    transaction = evm_transaction(
        1,
        0,
        value="1" + "0" * 38,
        receipt={"logs": [log, {"topics": ["x"]}]},
        flattened_traces=[trace, {"value": "-9"}],
    )
    [row] = rows(evm_transactions(blocks(spark, [evm_block(1, [transaction])])))
    assert row["value"] is None and row["value_string"] == "1" + "0" * 38
    first, second = row["traces"]
    assert (first["value"], first["value_string"]) == (None, "0x3")
    assert (first["gas"], first["gas_used"], first["trace_address"]) == (5, 4, [0, 2])
    assert (second["value"], second["trace_address"], second["error"]) == (Decimal(-9), None, "")
    one, two = row["receipt"]["logs"]
    assert (one["log_index"], one["topics"], one["removed"]) == (3, None, True)
    assert (two["log_index"], two["topics"], two["removed"]) == (0, ["x"], False)


@pytest.mark.parametrize(
    "chain, expected",
    [
        ("ethereum", [{}, {}]),
        ("arbitrum", [{"l1_gas_used": 1}, {"l1_gas_used": 0}]),
        (
            "optimism",
            [
                {"l1_gas_used": 1, "l1_gas_price": 2, "l1_fee": 3, "l1_fee_scalar": "s"},
                {"l1_gas_used": 0, "l1_gas_price": 0, "l1_fee": 0, "l1_fee_scalar": ""},
            ],
        ),
    ],
)
def test_receipts_by_chain(spark, chain, expected):
    fees = {"l1_gas_used": 1, "l1_gas_price": 2, "l1_fee": 3, "l1_fee_scalar": "s"}
    transactions = [
        evm_transaction(1, 0, receipt={"l1_fee_info": fees}),
        evm_transaction(1, 1, receipt={"l1_fee_info": None}),
    ]
    df = evm_transactions(blocks(spark, [evm_block(1, transactions)]), chain=chain)
    assert_schema(df, chain, TableKey("transactions"))
    found = [
        {k: v for k, v in r["receipt"].items() if k.startswith("l1_")}
        for r in sorted(rows(df), key=lambda r: r["transaction_index"])
    ]
    assert found == expected


def test_blocks_without_transactions_give_no_transactions(spark):
    source = blocks(spark, [evm_block(1), evm_block(2, [evm_transaction(2, 0)])])
    assert [r["block_number"] for r in rows(evm_transactions(source))] == [2]
    assert evm_transactions(source, columns=["transaction_hash"]).count() == 1
    assert evm_transactions(source, columns=[]).count() == 1


@pytest.mark.parametrize("chain", ["ethereum", "polygon"])
def test_evm_blocks(spark, chain):
    full = evm_block(
        12,
        uncles=[{"hash": "u", "number": 11, "timestamp": 5}],
        total_difficulty="77",
        withdrawals=[{"index": 1, "validator_index": 2, "address": "w", "amount": 3}, {}],
        withdrawals_root="r",
    )
    full["header"] |= {"uncles": ["u"], "transactions": ["t1", "t2"]}
    df = evm_blocks(blocks(spark, [full, evm_block(13)]), chain=chain, partition_by_size=10)
    assert_schema(df, chain, TableKey("blocks"))
    first, second = sorted(rows(df), key=lambda r: r["number"])
    assert (first["total_difficulty"], second["total_difficulty"]) == (Decimal(77), Decimal(0))
    assert (first["transaction_count"], second["transaction_count"]) == (2, 0)
    assert (first["transactions"], second["transactions"]) == (["t1", "t2"], None)
    assert (first["uncles"], second["uncles"]) == (["u"], None)
    assert first["uncle_blocks"][0]["number"] == 11 and second["uncle_blocks"] is None
    assert (first["_partition_by"], first["_repartition_by_range"]) == (10, 12)
    assert ("withdrawals" in first) == (chain == "ethereum")
    if chain == "ethereum":
        assert first["withdrawals"][1] == {
            "index": 0,
            "validator_index": 0,
            "address": "",
            "amount": 0,
        }
        assert (second["withdrawals"], second["withdrawals_root"]) == (None, "")


def test_bad_total_difficulty_fails_even_when_not_selected(spark):
    source = blocks(spark, [evm_block(1, total_difficulty="1.5")])
    with pytest.raises(SparkRuntimeException, match="total difficulty.*b1"):
        evm_blocks(source, columns=["hash"]).count()


def test_missing_header_fails(spark):
    bad = blocks(spark, [{"tag": 1, "header": None, "transactions": [evm_transaction(1, 0)]}])
    for table in (evm_transactions(bad), evm_blocks(bad)):
        with pytest.raises(SparkRuntimeException, match="header is required"):
            table.collect()
    with pytest.raises(SparkRuntimeException, match="header is required"):
        bitcoin_blocks(blocks(spark, [{"tag": 1}], "bitcoin")).collect()


def test_missing_receipt_fails(spark):
    source = blocks(spark, [evm_block(1, [evm_transaction(1, 0, receipt=None)])])
    with pytest.raises(SparkRuntimeException, match="without receipt"):
        evm_transactions(source).count()
    assert evm_transactions(source, columns=["transaction_hash"]).count() == 1


def test_narrow_columns_equal_the_full_table(spark, tmp_path):
    transactions = [evm_transaction(3, i, value=str(i), nonce=i) for i in range(3)]
    path = str(tmp_path / "blocks")
    blocks(spark, [evm_block(3, transactions)]).write.parquet(path)
    source = spark.read.parquet(path)
    names = ["transaction_hash", "nonce", "value"]
    narrow = evm_transactions(source, columns=names)
    full = evm_transactions(source).select(*narrow.columns)
    assert sorted(narrow.collect()) == sorted(full.collect())
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "flattened_traces" not in plan and "receipt" not in plan
    with pytest.raises(ValueError):
        evm_transactions(source, columns=["nothing"])


def test_unsigned_values_past_the_long_range(spark):
    big = 2**63
    source = blocks(spark, [evm_block(1, [evm_transaction(1, 0)])]).withColumn(
        "header", F.col("header").withField("number", F.lit(Decimal(big)).cast("decimal(20,0)"))
    )
    df = evm_transactions(source, u64="decimal", partition_by_size=1000)
    assert_schema(df, "ethereum", TableKey("transactions"), "decimal")
    [row] = rows(df)
    assert row["block"]["number"] == big
    assert row["_partition_by"] == big // 1000 * 1000
    with pytest.raises(Exception, match="OVERFLOW"):
        evm_transactions(source).collect()


def test_split_layout_equals_the_nested_one(spark):
    nested = blocks(
        spark, [evm_block(n, [evm_transaction(n, i) for i in range(n)]) for n in (1, 2, 3)]
    )
    keys = ["tag", F.col("header.number").alias("height"), F.col("header.hash").alias("hash")]
    headers = nested.select(*keys, "header")
    split = nested.select(*keys, F.explode("transactions").alias("transaction"))
    got = evm_split_transactions(split, headers, partition_by_size=2)
    assert got.columns == evm_transactions(nested).columns
    want = evm_transactions(nested, partition_by_size=2)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(SparkRuntimeException, match="header is required.*b3"):
        evm_split_transactions(split, headers.where("height < 3")).collect()


def test_null_elements_and_times_do_not_depend_on_the_columns(spark):
    block = rosetta_block(1, [{"transaction_identifier": {"hash": "t"}}], timestamp=None)
    empty = rosetta_block(2, [], timestamp=None)
    assert rosetta_transactions(blocks(spark, [empty], "rosetta")).count() == 0
    source = blocks(spark, [block], "rosetta")
    for columns in (None, ["transaction_hash", "block_timestamp"]):
        with pytest.raises(SparkRuntimeException, match="timestamp is required"):
            rosetta_transactions(source, columns=columns).collect()
    assert rosetta_transactions(source, columns=["transaction_hash"]).count() == 1
    holed = blocks(spark, [evm_block(1, [None, evm_transaction(1, 0)])])
    narrow = evm_transactions(holed, columns=["transaction_hash"]).collect()
    assert sorted(r.transaction_hash for r in narrow) == ["", "t1-0"]
    with pytest.raises(SparkRuntimeException, match="without receipt"):
        evm_transactions(holed).collect()


def bitcoin_source(spark):
    mint = {
        "transaction_id": "id0",
        "hash": "not used",
        "mints": True,
        "inputs": [{"minted": "cb", "sequence": 9}],
        "outputs": [{"index": 4, "value": 50}],
    }
    spend = {
        "transaction_id": "id1",
        "index": 1,
        "inputs": [
            {
                "transaction_id": "id0",
                "from_output_index": 2,
                "script_signature": {"assembly": "asm", "hex": "00"},
                "transaction_input_witnesses": ["w"],
                "from_output": {
                    "script_public_key": {"type": "pubkeyhash", "address": "a"},
                    "value": 7,
                },
            },
            {},
        ],
    }
    header = {"hash": "h", "height": 15, "time": 99, "number_of_transactions": 5}
    return blocks(
        spark, [{"tag": 1, "header": header, "transactions": [mint, spend]}], "bitcoin"
    )


def test_bitcoin_transactions(spark):
    df = bitcoin_transactions(bitcoin_source(spark), partition_by_size=10)
    assert_schema(df, "bitcoin", TableKey("transactions"))
    first, second = sorted(rows(df), key=lambda r: r["index"])
    [flag] = [f.name for f in df.schema if f.dataType.simpleString() == "boolean"]
    assert (first["hash"], first[flag], second[flag]) == ("id0", True, False)
    assert [list(item.values()) for item in first["inputs"]] == [
        [0, "cb", "", 0, "", "", 9, None, "", "", 0]
    ]
    assert first["outputs"][0]["index"] == 4 and second["outputs"] is None
    assert [i["index"] for i in second["inputs"]] == [0, 1]
    spent = second["inputs"][0]
    assert (spent["script_asm"], spent["address"], spent["value"]) == ("asm", "a", 7)
    assert spent["transaction_input_witnesses"] == ["w"]
    assert (first["block"]["number"], first["block"]["timestamp"]) == (15, 99)
    assert (first["_partition_by"], first["_repartition_by_range"]) == (10, 15)


def test_bitcoin_blocks(spark):
    df = bitcoin_blocks(bitcoin_source(spark), partition_by_size=10)
    assert_schema(df, "bitcoin", TableKey("blocks"))
    [row] = rows(df)
    assert (row["number"], row["transaction_count"]) == (15, 5)
    assert row["transactions"] == ["id0", "id1"]


def test_split_transactions_are_cut_before_headers_are_joined(spark):
    nested = blocks(spark, [evm_block(n, [evm_transaction(n, i) for i in range(n)], parent_hash=f"b{n - 1}") for n in range(5)])
    keys = ("tag", F.col("header.number").alias("height"), F.col("header.hash").alias("hash"))
    headers = nested.select(*keys, "header")
    split = nested.select(*keys, F.explode("transactions").alias("transaction"))
    whole = evm_split_transactions(split, headers, partition_by_size=2)
    wanted = ["transaction_hash", F.size("traces").alias("traces"), F.col("receipt.status").alias("status"), "_partition_by"]
    got = evm_split_transactions(split, headers, partition_by_size=2, cut=wanted)
    assert got.columns == ["transaction_hash", "traces", "status", "_partition_by", "block"]
    expected = whole.select(*wanted, "block")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 10
    alone = evm_split_transactions(split, headers, columns=["transaction_hash"], cut=["transaction_hash"])
    assert alone.columns == ["transaction_hash"] and alone.count() == 10
    # Lists are counted below the join: no shuffle carries them.
    joined = got._jdf.queryExecution().optimizedPlan().toString()
    assert joined.index("Join") < joined.index("size(")
    with pytest.raises(SparkRuntimeException, match="header is required"):
        evm_split_transactions(split, headers.where("height < 3"), cut=wanted).collect()


def test_bitcoin_split_layout(spark):
    nested = bitcoin_source(spark)
    keys = ["tag", F.col("header.height").alias("height"), F.col("header.hash").alias("hash")]
    split = nested.select(*keys, F.explode("transactions").alias("transaction"))
    got = bitcoin_split_transactions(split, nested.select(*keys, "header"))
    want = bitcoin_transactions(nested)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rosetta_transactions(spark):
    operation = {
        "operation_identifier": {"index": 1, "network_index": 2},
        "related_operations": [{"index": 0}],
        "type": "CALL",
        "account": {"address": "a", "sub_account": {"address": "s"}},
        "amount": {"value": "-5", "currency": {"symbol": "ETH", "decimals": 18}},
        "coin_change": {"coin_identifier": {"identifier": "c"}, "coin_action": "COIN_SPENT"},
        "metadata": {"b": "1", "a": '"x"'},
    }
    bare = {"operation_identifier": {"index": 3}}
    transactions = [
        {"transaction_identifier": {"hash": "t0"}, "operations": [operation, bare]},
        {
            "transaction_identifier": {"hash": "t1"},
            "related_transactions": [
                {"transaction_identifier": {"hash": "t0"}, "direction": "FORWARD"},
                {"transaction_identifier": {"hash": "t9"}},
            ],
            "metadata": {"k": '{"v":1}'},
        },
    ]
    df = rosetta_transactions(
        blocks(spark, [rosetta_block(5, transactions)], "rosetta"), partition_by_size=3
    )
    assert_schema(df, "ethereum", TableKey("transactions", "rosetta"))
    first, second = sorted(rows(df), key=lambda r: r["transaction_index"])
    assert (first["transaction_index"], second["transaction_index"]) == (0, 1)
    assert (first["operation_count"], second["operation_count"]) == (2, 0)
    assert (first["metadata"], second["metadata"]) == ("", '{"k":{"v":1}}')
    assert second["operations"] is None and first["related_transactions"] is None
    assert [r["direction"] for r in second["related_transactions"]] == [
        "FORWARD",
        "DIRECTION_UNSPECIFIED",
    ]
    full, empty = first["operations"]
    assert (full["amount_value"], full["amount_string"]) == (Decimal(-5), "-5")
    assert (full["sub_account_address"], full["coin_change_action"]) == ("s", "COIN_SPENT")
    assert full["related_operations"] == [{"operation_index": 0, "network_index": 0}]
    assert full["metadata"] == '{"a":"x","b":1}'
    assert (empty["amount_value"], empty["amount_string"]) == (Decimal(0), "")
    assert (empty["amount_decimals"], empty["related_operations"]) == (0, None)
    assert empty["coin_change_action"] == "COIN_ACTION_UNSPECIFIED"
    assert (first["_partition_by"], first["_repartition_by_range"]) == (3, 5)


def test_rosetta_blocks(spark):
    transactions = [{"transaction_identifier": {"hash": h}} for h in ("x", "y")]
    source = blocks(
        spark,
        [rosetta_block(5, transactions, metadata={"z": "1"}), rosetta_block(6)],
        "rosetta",
    )
    df = rosetta_blocks(source)
    assert_schema(df, "ethereum", TableKey("blocks", "rosetta"))
    first, second = sorted(rows(df), key=lambda r: r["number"])
    assert (first["transactions"], first["transaction_count"]) == (["x", "y"], 2)
    assert (second["transactions"], second["transaction_count"]) == (None, 0)
    assert (first["parent_number"], first["parent_hash"]) == (4, "b4")
    assert (first["metadata"], second["metadata"]) == ('{"z":1}', "")


@pytest.mark.parametrize(
    "block, message",
    [
        (rosetta_block(1, [{"transaction_identifier": None}]), "transaction_identifier"),
        (
            rosetta_block(1, [{"transaction_identifier": {"hash": "t"}, "operations": [{}]}]),
            "operations",
        ),
        (
            rosetta_block(
                1, [{"transaction_identifier": {"hash": "t"}, "related_transactions": [{}]}]
            ),
            "related_transactions",
        ),
        (
            {**rosetta_block(1, [{"transaction_identifier": {"hash": "t"}}]), "timestamp": None},
            "timestamp",
        ),
    ],
)
def test_rosetta_required_members(spark, block, message):
    with pytest.raises(SparkRuntimeException, match=message):
        rosetta_transactions(blocks(spark, [block], "rosetta")).collect()


def test_json_blocks_must_be_well_formed(spark):
    texts = spark.createDataFrame([(json.dumps(evm_block(1)) + "}",), ("{oops",)], "value STRING")
    from blockloom.sources.blocks import parse_blocks

    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        parse_blocks(texts).collect()


def test_a_table_of_ones_own(spark):
    key = TableKey("heights_test")
    register_builder(
        "polygon", key, "evm", lambda df, **_: df.select(F.col("header.number").alias("n"))
    )
    assert build("polygon", key, blocks(spark, [evm_block(4)])).collect() == [(4,)]
    with pytest.raises(ValueError):
        register_builder("polygon", key, "evm", lambda df, **_: df)
    with pytest.raises(ValueError):
        register_builder("polygon", TableKey("blocks"), "evm", lambda df, **_: df)
