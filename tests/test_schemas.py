from __future__ import annotations

import pytest

from blockloom import NotFound, TableKey
from blockloom.plans.catalog import get_schema, tables_for
from blockloom.schemas.tables import FAMILIES, NETWORK_FORMATS, table_schema, tables_of

WIDTHS = {
    TableKey("transactions"): 22,
    TableKey("blocks"): 24,
    TableKey("streamed_transactions"): 24,
    TableKey("streamed_blocks"): 26,
    TableKey("streamed_transactions", "native", "raw"): 10,
    TableKey("transactions", "rosetta"): 11,
    TableKey("blocks", "rosetta"): 10,
    TableKey("streamed_transactions", "rosetta", "raw"): 7,
}


@pytest.mark.parametrize("chain", [c for c, family in FAMILIES.items() if family == "evm"])
def test_evm_widths(chain):
    extra = 2 if chain == "ethereum" else 0
    for key, width in WIDTHS.items():
        wide = extra if key.format == "native" and "blocks" in key.table else 0
        assert len(table_schema(chain, key)) == width + wide, key


def test_bitcoin_widths():
    assert {len(table_schema("bitcoin", key)) for key in tables_of("bitcoin")} == {18}


def nested(schema, *path):
    dtype = schema
    for step in path:
        dtype = dtype[step].dataType
        dtype = getattr(dtype, "elementType", dtype)
    return dtype


@pytest.mark.parametrize(
    "chain, width", [("ethereum", 15), ("polygon", 15), ("bsc", 15), ("arbitrum", 16), ("optimism", 19)]
)
def test_receipt_width(chain, width):
    assert len(nested(get_schema(chain, "transactions"), "receipt")) == width


def test_nested_widths():
    evm = get_schema("ethereum", "transactions")
    assert len(nested(evm, "block")) == 9
    assert len(nested(evm, "receipt", "logs")) == 9
    assert len(nested(evm, "traces")) == 20
    blocks = get_schema("ethereum", "blocks")
    assert len(nested(blocks, "uncle_blocks")) == 9
    assert len(nested(blocks, "withdrawals")) == 4
    bitcoin = get_schema("bitcoin", "transactions")
    assert len(nested(bitcoin, "block")) == 15
    assert len(nested(bitcoin, "inputs")) == 11
    assert len(nested(bitcoin, "outputs")) == 6
    rosetta = get_schema("ethereum", "transactions", "rosetta")
    assert len(nested(rosetta, "operations")) == 14
    assert len(nested(rosetta, "operations", "related_operations")) == 2
    assert len(nested(rosetta, "related_transactions")) == 2
    raw = get_schema("ethereum", "streamed_transactions", "rosetta", "raw")
    assert len(nested(raw, "block_info")) == 3
    assert len(nested(raw, "block_info", "block_identifier")) == 2


def test_every_column_is_nullable_and_described():
    def check(dtype):
        for field in getattr(dtype, "fields", []):
            assert field.nullable and field.metadata["comment"]
            check(getattr(field.dataType, "elementType", field.dataType))

    for chain in FAMILIES:
        for key in tables_of(chain):
            check(table_schema(chain, key))


def test_streamed_tables_start_with_the_event():
    for key in tables_of("ethereum"):
        names = table_schema("ethereum", key).names
        assert (names[:2] == ["_sequence_number", "_event_type"]) == key.streamed
        assert names[-2:] == ["_partition_by", "_repartition_by_range"]


def test_unsigned_policy():
    assert get_schema("ethereum", "blocks")["number"].dataType.simpleString() == "bigint"
    wide = get_schema("ethereum", "streamed_blocks", u64="decimal")
    assert wide["number"].dataType.simpleString() == "decimal(20,0)"
    assert wide["_sequence_number"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        get_schema("ethereum", "blocks", u64="int")


def test_keys_and_lookup():
    assert str(TableKey("blocks")) == "table=blocks/format=native/encoding=none"
    assert str(TableKey("t", "rosetta", "raw")) == "table=t/format=rosetta/encoding=raw"
    for missing in [("nothing",), ("blocks", "rosetta", "raw")]:
        with pytest.raises(NotFound):
            get_schema("ethereum", *missing)
    with pytest.raises(NotFound):
        get_schema("dogecoin", "blocks")


@pytest.mark.parametrize("chain, network", list(NETWORK_FORMATS))
def test_networks_offer_their_formats(chain, network):
    keys = tables_for(chain, network)
    assert keys
    assert {k.format for k in keys} <= set(NETWORK_FORMATS[chain, network])
    with pytest.raises(NotFound):
        tables_for(chain, "nowhere")


def test_seven_networks():
    assert len(NETWORK_FORMATS) == 7
    assert len(tables_for("ethereum", "mainnet")) == 8
    assert len(tables_for("bsc", "mainnet")) == 5
    assert len(tables_for("bitcoin", "mainnet")) == 2
