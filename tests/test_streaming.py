from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from blockloom import InvalidArgument, TableKey
from blockloom.metrics import BLOCKS_PROCESSED
from blockloom.sinks.layout import read_table
from blockloom.sources.blocks import read_blocks
from blockloom.sources.events import stream_events
from blockloom.streaming.streams import (
    backfill,
    replay,
    start_position,
    stream_table,
    streamed_table,
)
from tests.fixtures import blocks, events, evm_block, evm_transaction, rosetta_block

ADDED, REMOVED = "BLOCK_ADDED", "BLOCK_REMOVED"


def evm_rows(numbers):
    return [evm_block(n, [evm_transaction(n, i) for i in range(n % 3)]) for n in numbers]


def rosetta_rows(numbers):
    return [
        rosetta_block(n, [{"transaction_identifier": {"hash": f"t{n}"}}] * (n % 2))
        for n in numbers
    ]


def log(start, numbers):
    """Every block is added; every third is removed again."""
    rows = []
    for n in numbers:
        rows.append((start + len(rows), ADDED, 1, n, f"b{n}"))
        if n % 3 == 0:
            rows.append((start + len(rows), REMOVED, 1, n, f"b{n}"))
    return rows


def land(spark, store, rows, numbers, family="evm"):
    made = evm_rows(numbers) if family == "evm" else rosetta_rows(numbers)
    blocks(spark, made, family).write.mode("append").parquet(f"{store}/blocks")
    events(spark, rows).coalesce(1).write.mode("append").parquet(f"{store}/events")


def run(spark, store, key, family="evm", start=None):
    query = (
        stream_table(
            "ethereum",
            key,
            stream_events(spark, f"{store}/events", start=start, max_files=1),
            lambda session: read_blocks(session, f"{store}/blocks", family),
            f"{store}/table",
            f"{store}/checkpoint",
            partition_by_size=4,
        )
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def written(spark, store, like):
    df = read_table(spark, f"{store}/table").drop("batch_id", "run")
    return df.withColumn("_partition_by", F.col("_partition_by").cast("bigint")).select(
        *like.columns
    )


KEYS = [
    (TableKey("streamed_transactions"), "evm"),
    (TableKey("streamed_blocks"), "evm"),
    (TableKey("streamed_transactions", "native", "raw"), "evm"),
    (TableKey("streamed_transactions", "rosetta", "raw"), "rosetta"),
]


@pytest.mark.parametrize("key, family", KEYS)
def test_stream_equals_replay(spark, tmp_path, key, family):
    store = str(tmp_path)
    first, second = log(1, range(1, 7)), log(100, range(7, 12))
    land(spark, store, first, range(1, 7), family)
    run(spark, store, key, family)
    # Blocks that land later must be seen, and the stream must resume where it was.
    land(spark, store, second, range(7, 12), family)
    run(spark, store, key, family)
    want = replay(
        "ethereum",
        key,
        events(spark, first + second),
        read_blocks(spark, f"{store}/blocks", family),
        partition_by_size=4,
    )
    got = written(spark, store, want)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.count() > 5


def test_a_repeated_batch_leaves_no_double_rows(spark, tmp_path):
    store, key = str(tmp_path), TableKey("streamed_blocks")
    land(spark, store, log(1, range(1, 7)), range(1, 7))
    run(spark, store, key)
    before = read_table(spark, f"{store}/table").count()
    # As if the run had died after writing: its last commit is not recorded.
    [commit] = [p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name == "0"]
    commit.unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(".0.crc"):
        crc.unlink()
    run(spark, store, key)
    assert read_table(spark, f"{store}/table").count() == before


def test_a_new_checkpoint_writes_beside_the_old_rows(spark, tmp_path):
    store, key = str(tmp_path), TableKey("streamed_blocks")
    land(spark, store, log(1, range(1, 7)), range(1, 7))
    run(spark, store, key)
    before = read_table(spark, f"{store}/table").count()
    (tmp_path / "checkpoint").rename(tmp_path / "old")
    (tmp_path / "events").rename(tmp_path / "old-events")
    land(spark, store, log(100, range(7, 9)), range(7, 9))
    run(spark, store, key)
    assert read_table(spark, f"{store}/table").count() == before + 2


def test_a_backfill_of_another_size_or_a_part_leaves_no_double_rows(spark, tmp_path):
    frame, source = events(spark, log(10, range(1, 12))), blocks(spark, evm_rows(range(1, 12)))
    key, path = TableKey("streamed_blocks"), str(tmp_path / "table")
    backfill("ethereum", key, frame, source, path, events_per_slice=4)
    with pytest.raises(InvalidArgument, match="slices of 4"):
        backfill("ethereum", key, frame, source, path, events_per_slice=8)
    backfill("ethereum", key, frame, source, path, 13, 15, events_per_slice=4)
    assert read_table(spark, path).count() == frame.count()


def test_events_before_their_blocks_fail_the_batch(spark, tmp_path):
    store = str(tmp_path)
    land(spark, store, log(1, range(1, 5)), range(1, 3))
    with pytest.raises(StreamingQueryException, match="no block for an event"):
        run(spark, store, TableKey("streamed_blocks"))


def test_start_position(spark, tmp_path):
    store, rows = str(tmp_path), log(5, range(1, 5))
    frame = events(spark, rows)
    assert start_position(frame, 7) == 7
    assert start_position(frame, "EARLIEST") == 5
    assert start_position(frame, "LATEST") == 9
    with pytest.raises(InvalidArgument):
        start_position(frame, "MIDDLE")
    land(spark, store, rows, range(1, 5))
    run(spark, store, TableKey("streamed_blocks"), start=7)
    got = read_table(spark, f"{store}/table").select("_sequence_number").collect()
    assert sorted(r[0] for r in got) == [7, 8, 9]


def test_progress_counts_events(spark, tmp_path):
    store = str(tmp_path)
    land(spark, store, log(1, range(1, 7)), range(1, 7))
    land(spark, store, log(100, range(7, 9)), range(7, 9))
    query = run(spark, store, TableKey("streamed_transactions"))
    counted = [p.observedMetrics[BLOCKS_PROCESSED][0] for p in query.recentProgress]
    assert sorted(counted) == [2, 8]


def test_replay_is_clamped_and_streamed_only(spark):
    rows, source = log(10, range(1, 7)), blocks(spark, evm_rows(range(1, 7)))
    frame = events(spark, rows)
    key = TableKey("streamed_blocks")
    assert replay("ethereum", key, frame, source, 12, 15).count() == 3
    assert replay("ethereum", key, frame, source, 0, 99).count() == len(rows)
    with pytest.raises(InvalidArgument):
        replay("ethereum", key, frame, source, 99)
    with pytest.raises(InvalidArgument):
        streamed_table("ethereum", TableKey("blocks"), frame, source)


def test_backfill_equals_replay(spark, tmp_path):
    frame, source = events(spark, log(10, range(1, 12))), blocks(spark, evm_rows(range(1, 12)))
    key, path = TableKey("streamed_transactions"), str(tmp_path / "table")
    for _ in range(2):  # writing again changes nothing
        backfill("ethereum", key, frame, source, path, 0, 20, events_per_slice=4)
    assert sorted(p.name for p in (tmp_path / "table").iterdir() if "=" in p.name) == [
        "slice=12",
        "slice=16",
        "slice=8",
    ]
    want = replay("ethereum", key, frame, source, 0, 20)
    got = read_table(spark, path).withColumn(
        "_partition_by", F.col("_partition_by").cast("bigint")
    )
    got = got.select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
