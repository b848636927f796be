from __future__ import annotations

import datetime
import decimal
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from blockloom.functions import scalars

NINES = "9" * 38
TOO_LONG = "1" + "0" * 38
U = "\\u"


def values(spark, rows, dtype, build):
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], f"i INT, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("123", 123),
        ("12345678901234567890", 12345678901234567890),
        ("-123", -123),
        ("", 0),
        (None, 0),
        ("123.0", None),
        ("0x3", None),
        (NINES, int(NINES)),
        ("-" + NINES, -int(NINES)),
        (TOO_LONG, None),
        ("-" + TOO_LONG, None),
        ("+5", 5),
        ("+" + NINES, None),
        ("0" * 38, 0),
        ("0" * 39, None),
        ("-", None),
        ("+", None),
        ("5-", None),
        ("1-2", None),
        ("--5", None),
        (" 5", None),
        ("5\n", None),
        ("1e3", None),
        ("1_000", None),
        ("٣", None),
    ],
)
def test_decimal38(spark, text, expected):
    [got] = values(spark, [text], "STRING", scalars.decimal38)
    assert got == (None if expected is None else decimal.Decimal(expected))


def test_decimal38_agrees_with_its_rule(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.text(alphabet="+-0123456789. x", max_size=42), min_size=1, max_size=50))
    def check(texts):
        def rule(text):
            if text == "":
                return 0
            if not re.fullmatch(r"[+-]?[0-9]+", text) or len(text.removeprefix("-")) > 38:
                return None
            return int(text)

        assert values(spark, texts, "STRING", scalars.decimal38) == [rule(t) for t in texts]

    check()


def test_decimal38_strict_names_the_block(spark):
    strict = lambda x: scalars.decimal38_strict(x, F.lit("b7"))
    assert values(spark, ["12", ""], "STRING", strict) == [12, 0]
    with pytest.raises(SparkRuntimeException, match="0x3.*hash=b7"):
        values(spark, ["0x3"], "STRING", strict)


def test_null_if_empty(spark):
    rows = [["a"], [], None, [None]]
    assert values(spark, rows, "ARRAY<STRING>", scalars.null_if_empty) == [
        ["a"],
        None,
        None,
        [None],
    ]


@pytest.mark.parametrize("size, expected", [(0, 0), (1, 1234), (100, 1200), (5000, 0)])
@pytest.mark.parametrize("dtype", ["BIGINT", "DECIMAL(20,0)"])
def test_partition_floor(spark, size, expected, dtype):
    build = lambda x: scalars.partition_floor(x.cast(dtype), size)
    assert values(spark, [1234], "BIGINT", build) == [expected]


def test_partition_floor_refuses_negative_size():
    with pytest.raises(ValueError):
        scalars.partition_floor(None, -1)


def test_epoch_seconds(spark):
    moment = datetime.datetime(2020, 1, 2, 3, 4, 5, 999_999)
    zone = spark.conf.get("spark.sql.session.timeZone")
    ntz = lambda x: scalars.epoch_seconds(x, ntz=True)
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert values(spark, [moment, None], "TIMESTAMP_NTZ", ntz) == [1577934245, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    aware = moment.replace(tzinfo=datetime.UTC)
    assert values(spark, [aware], "TIMESTAMP", scalars.epoch_seconds) == [1577934245]


def test_enum_name(spark):
    text = lambda x: scalars.enum_name(x, scalars.EVENT_TYPES)
    number = lambda x: scalars.enum_name(x, scalars.COIN_ACTIONS, numeric=True)
    assert values(spark, ["BLOCK_ADDED", None], "STRING", text) == ["BLOCK_ADDED", "UNKNOWN"]
    assert values(spark, [1, 2, 9, None], "INT", number) == [
        "COIN_CREATED",
        "COIN_SPENT",
        "9",
        "COIN_ACTION_UNSPECIFIED",
    ]


def test_element_count(spark):
    assert values(spark, [[1, 2], [], None], "ARRAY<INT>", scalars.element_count) == [2, 0, 0]


@pytest.mark.parametrize(
    "metadata, expected",
    [
        (None, ""),
        ({}, ""),
        ({"a": None}, ""),
        ({"b": "1", "a": '"x"', "c": None}, '{"a":"x","b":1}'),
        ({"a": ' { "k" : [ 1, 2 ],\n "s" : "a  b" } '}, '{"a":{"k":[1,2],"s":"a  b"}}'),
        ({"a": r'{"q": "say \"x  y\" \\", "z": 1 }'}, r'{"a":{"q":"say \"x  y\" \\","z":1}}'),
        ({"<k>&": '"<v>"'}, f'{{"{U}003ck{U}003e{U}0026":"{U}003cv{U}003e"}}'),
        ({'q"\\': "1"}, r'{"q\"\\":1}'),
        ({"l\n\t\x01\x1f": "1"}, f'{{"l\\n\\t{U}0001{U}001f":1}}'),
        ({"k": f'"{chr(0x2028)}"'}, f'{{"k":"{U}2028"}}'),
        ({"Z": "1", "a": "2", "é": "3"}, '{"Z":1,"a":2,"é":3}'),
    ],
)
def test_metadata_json(spark, metadata, expected):
    [got] = values(spark, [metadata], "MAP<STRING,STRING>", scalars.metadata_json)
    assert got == expected
    if got:
        json.loads(got)


def test_raw_payload(spark):
    df = spark.range(1).select(F.struct(F.lit("h").alias("hash"), F.lit(3).alias("n")).alias("t"))
    [row] = df.select(scalars.raw_payload(F.col("t"))).collect()
    assert json.loads(bytes(row[0])) == {"hash": "h", "n": 3}
    with pytest.raises(ValueError):
        scalars.raw_payload(F.col("t"), codec="avro")
    with pytest.raises(ValueError):
        scalars.raw_payload(F.col("t"), codec="protobuf")


def test_require_fails_though_nothing_is_selected(spark):
    df = spark.range(5)
    assert df.where(scalars.require(F.col("id") > 9, "too big")).count() == 5
    with pytest.raises(SparkRuntimeException, match="too big"):
        df.where(scalars.require(F.col("id") > 3, "too big")).count()
