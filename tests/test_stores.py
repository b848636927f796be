"""Stores with directories and buckets, split stores, and tables written slice by slice."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from blockloom import BatchQuery, ChainMetadata, InvalidArgument, Ledger, NotFound, StreamQuery, TableKey
from blockloom.operators import events as joins
from blockloom.operators.evm import evm_blocks, evm_transactions
from blockloom.plans import ranges
from blockloom.plans.catalog import create_tables, list_tables, refresh_table, table_path, table_size
from blockloom.sinks import slices
from blockloom.sinks.layout import SIZE_NOTE, note, read_note, read_table, write_table
from blockloom.sources.blocks import (
    BlockStore,
    SplitStore,
    read_block_store,
    read_blocks,
    store_sizes,
    write_block_store,
)
from blockloom.sources.events import footer_statistics, read_event_store, scan_events, stream_events, write_event_store
from blockloom.streaming.streams import backfill, finished_batches, read_streamed, replay, stream_table
from tests.fixtures import blocks, events, evm_block, evm_transaction
from tests.test_streaming import evm_rows, log


def text(df):
    """Rows as text, the directory as a number: what is read back is typed by its path."""
    df = df.withColumn("_partition_by", F.col("_partition_by").cast("bigint"))
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- notes and appends -----------------------------------------------------------------


def test_notes_are_created_once_and_read_back(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_note(spark, path, "_size") is None
    assert note(spark, path, "_size", "7") == "7" and note(spark, path, "_size", "8") == "7"
    spark.createDataFrame([("9",)], "value STRING").coalesce(1).write.text(f"{path}/_older")
    assert read_note(spark, path, "_older") == "9"


def test_append_needs_a_known_size(spark, tmp_path):
    path = str(tmp_path / "table")
    made = lambda low, high, size: evm_blocks(blocks(spark, evm_rows(range(low, high))), partition_by_size=size)
    write_table(made(1, 21, 0), path)
    (tmp_path / "table" / SIZE_NOTE).unlink()
    with pytest.raises(InvalidArgument, match="isn't known"):
        write_table(made(21, 41, 10), path, mode="append")
    other = str(tmp_path / "other")
    write_table(made(1, 21, 10), other, mode="append")
    with pytest.raises(InvalidArgument, match="partitioned by 10"):
        write_table(made(21, 41, 20), other, mode="append")
    write_table(made(21, 41, 10), other, mode="append")
    assert read_table(spark, other, start=10, end=40).count() == 30


def test_unsigned_values_are_refused_where_casts_wrap(spark):
    wide = blocks(spark, evm_rows([1])).withColumn("more", F.lit(1).cast("decimal(20,0)"))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(InvalidArgument, match="ansi"):
            evm_blocks(wide)
        evm_blocks(wide, u64="decimal")
        evm_blocks(blocks(spark, evm_rows([1])))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


# --- event stores ----------------------------------------------------------------------


@pytest.fixture()
def store(spark, tmp_path):
    rows = log(103, range(1, 40))
    write_event_store(events(spark, rows), str(tmp_path / "log"), 10)
    return read_event_store(spark, str(tmp_path / "log")), rows


def test_event_store_finds_positions_without_reading_events(spark, store):
    found, rows = store
    assert ranges.stream_earliest(found) == 103 and ranges.stream_tip(found) == rows[-1][0]
    assert ranges.event_bounds(found) == (103, rows[-1][0])
    span = ranges.resolve_stream_range(found, 0, 10**9)
    assert (span.start, span.end) == (103, rows[-1][0] + 1)
    with footer_statistics(spark):
        made = plan(found.extremes(found.buckets()[-1]))
    assert "PushedAggregation: [MIN(sequence_num), MAX(sequence_num)]" in made
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_event_store_reads_only_its_directories(spark, store, tmp_path):
    found, rows = store
    part = scan_events(found, 118, 132)
    assert sorted(r.sequence_num for r in part.collect()) == list(range(118, 132))
    assert "PartitionFilters: [isnotnull(sequence_bucket" in plan(part)
    with pytest.raises(InvalidArgument, match="10 sequences"):
        write_event_store(events(spark, rows), found.path, 20)
    more = log(rows[-1][0] + 1, range(40, 45))
    write_event_store(events(spark, more), found.path, 10)
    assert read_event_store(spark, found.path).frame.count() == len(rows) + len(more)
    with pytest.raises(NotFound):
        read_event_store(spark, str(tmp_path))


def test_replay_and_backfill_from_an_event_store(spark, store, tmp_path):
    found, rows = store
    source, key = blocks(spark, evm_rows(range(1, 40))), TableKey("streamed_transactions")
    want = replay("ethereum", key, events(spark, rows), source, 110, 140)
    assert text(replay("ethereum", key, found, source, 110, 140)) == text(want)
    path = str(tmp_path / "table")
    made = backfill("ethereum", key, found, source, path, events_per_slice=16)
    assert made.processed == len(rows) == slices.processed(spark, path)
    assert text(slices.read_slices(spark, path, start=110, end=140).select(*want.columns)) == text(want)


# --- bucketed block stores -------------------------------------------------------------


def hot_log(spark, n):
    """Events that name some blocks once and one of them very often."""
    rows = [(k, "BLOCK_ADDED", 1, 7 if k % 3 else 1 + k % 30, f"b{7 if k % 3 else 1 + k % 30}") for k in range(n)]
    return events(spark, rows)


def test_bucketed_blocks_are_joined_where_they_lie(spark, tmp_path, monkeypatch):
    source = blocks(spark, evm_rows(range(1, 31)))
    write_block_store(source, "bucketed_blocks", str(tmp_path / "blocks"), bucket_size=10, buckets=4)
    try:
        stored = read_block_store(spark, "bucketed_blocks", 10)
        assert stored.frame.count() == 30
        frame = hot_log(spark, 60)
        large = replace(joins.event_stats(frame), bytes=joins.BROADCAST_BYTES + 1)
        monkeypatch.setattr(joins, "HOT_BLOCKS", 1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        resolved = joins.resolve_events(frame, stored, stats=large)
        assert no_shuffle_above(plan(resolved), "transactions")
        want = text(evm_transactions(joins.resolve_events(frame, source), partition_by_size=10))
        assert text(evm_transactions(resolved, partition_by_size=10)) == want
        # One block has two thirds of all events: it is joined apart, and no row is lost.
        monkeypatch.setattr(joins, "HOT_BLOCKS", 10)
        assert len(joins._hot_blocks(joins._event_keys(frame), large)) == 1
        apart = joins.resolve_events(frame, stored, stats=large)
        assert "Union" in plan(apart)
        assert text(evm_transactions(apart, partition_by_size=10)) == want
        landed = stored.frame.where("block_height <> 10")
        lost = BlockStore(landed, "height_bucket", 10, "block_height", "block_hash")
        with pytest.raises(NotFound, match="height 10"):
            joins.resolve_events(frame, lost, stats=large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_blocks")


def no_shuffle_above(text, column):
    """Whether no exchange lies between the scan that reads a column and the root."""
    lines = text.splitlines()
    [scan] = [k for k, line in enumerate(lines) if "FileScan" in line and f"{column}#" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            at = depth(line)
            if "Exchange" in line:
                return False
    return True


# --- split stores and huge blocks ------------------------------------------------------


@pytest.fixture()
def chains(spark):
    rows = [evm_block(n, [evm_transaction(n, i) for i in range(n % 4)]) for n in range(40)]
    nested = blocks(spark, rows).persist()
    headers = nested.selectExpr("tag", "header.number AS height", "header.hash AS hash", "header")
    parts = nested.select(
        "tag", F.col("header.number").alias("height"), F.col("header.hash").alias("hash"), F.explode("transactions").alias("transaction")
    )
    log_ = events(spark, log(5, range(1, 30)))
    about = ChainMetadata(2, 3)
    return (
        Ledger("ethereum", "mainnet", {"evm": nested}, log_, about),
        Ledger("ethereum", "mainnet", {"evm": SplitStore(parts, headers, nested)}, log_, about),
        Ledger("ethereum", "mainnet", {"evm": SplitStore(parts, headers)}, log_, about),
    )


def test_ledger_reads_split_stores(chains):
    nested, split, bare = chains
    assert split.tip() == nested.tip()
    for table in ("transactions", "blocks"):
        query = BatchQuery(table, 5, 30, partition_by_size=10)
        assert text(split.batch(query)) == text(nested.batch(query))
    stream = StreamQuery("streamed_transactions", partition_by_size=10)
    assert text(split.stream(stream)) == text(nested.stream(stream))
    narrow = split.batch(BatchQuery("transactions"), columns=["transaction_hash"])
    assert "Join" not in plan(narrow)
    with pytest.raises(NotFound, match="no blocks"):
        bare.batch(BatchQuery("blocks"))
    gone = SplitStore(split.blocks["evm"].transactions, split.blocks["evm"].headers.where("height <> 8"))
    with pytest.raises(NotFound, match="first 8"):
        Ledger("ethereum", "mainnet", {"evm": gone}, None, ChainMetadata(2, 3)).batch(BatchQuery("transactions"))


@pytest.mark.parametrize("family", ["evm", "rosetta"])
def test_a_huge_block_is_dealt_out(spark, family):
    if family == "evm":
        rows = [evm_block(n, [evm_transaction(n, i) for i in range(500 if n == 3 else 2)]) for n in range(6)] + [evm_block(6)]
        query = BatchQuery("transactions", 0, 7, partition_by_size=10)
    else:
        one = lambda n, i: {"transaction_identifier": {"hash": f"t{n}-{i}"}}
        rows = [
            {
                "tag": 1,
                "block_identifier": {"index": n, "hash": f"b{n}"},
                "parent_block_identifier": {"index": max(0, n - 1), "hash": "p"},
                "timestamp": 1,
                "transactions": [one(n, i) for i in range(500 if n == 3 else n % 2)],
            }
            for n in range(7)
        ]
        query = BatchQuery("transactions", 0, 7, format="rosetta", partition_by_size=10)
    source = blocks(spark, rows, family).coalesce(1)
    ledger = Ledger("ethereum", "mainnet", {family: source})
    want = ledger.batch(query)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = ledger.batch(query, spread=20)
        tasks = {r.task for r in made.select(F.spark_partition_id().alias("task")).distinct().collect()}
        assert len(tasks) > 1 and len({r.t for r in want.select(F.spark_partition_id().alias("t")).collect()}) == 1
        assert text(made) == text(want)
        few = ledger.batch(query, spread=7, columns=["transaction_hash"])
        assert text(few) == text(want.select(*few.columns))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with pytest.raises(InvalidArgument):
        ledger.batch(query, spread=0)


# --- slices and their log --------------------------------------------------------------


def test_a_backfill_goes_on_after_a_failure(spark, chains, tmp_path, monkeypatch):
    nested, split, _ = chains
    path = str(tmp_path / "table")
    query = BatchQuery("transactions", partition_by_size=10, blocks_per_partition=8)
    want = text(nested.batch(query))
    written = []

    def failing(spark, path, begins, end_of, write, at_once):
        def once(begin, end, directory):
            if begin == 24 and not written.count(24):
                written.append(24)
                raise RuntimeError("killed")
            written.append(begin)
            return write(begin, end, directory)

        return slices.write_slices(spark, path, begins, end_of, once, 1)

    monkeypatch.setattr("blockloom.ledger.write_slices", failing)
    with pytest.raises(RuntimeError, match="killed"):
        nested.backfill(query, path)
    assert written == [0, 8, 16, 24]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "table" / "slice=8").rglob("*.parquet")}
    assert text(slices.read_slices(spark, path)) != want
    # Half of a slice that was never finished is nothing to a reader.
    nested.batch(BatchQuery("transactions", 24, 30, partition_by_size=10)).write.partitionBy("_partition_by").parquet(f"{path}/slice=24")
    assert slices.read_slices(spark, path).where("_repartition_by_range >= 24").count() == 0
    made = nested.backfill(query, path)
    assert written[4:] == [24, 32] and (made.written, made.skipped) == (2, 3)
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "table" / "slice=8").rglob("*.parquet")}
    got = slices.read_slices(spark, path)
    assert text(got.select(*nested.batch(query).columns)) == want
    assert slices.processed(spark, path) == nested.tip() - 2
    assert nested.backfill(query, path).written == 0
    ranged = slices.read_slices(spark, path, start=9, end=20)
    assert {r._repartition_by_range for r in ranged.collect()} <= set(range(9, 20))
    monkeypatch.undo()
    for wrong in (replace(query, blocks_per_partition=9), replace(query, table="blocks"), replace(query, partition_by_size=5)):
        with pytest.raises(InvalidArgument):
            nested.backfill(wrong, path)
    other = str(tmp_path / "split")
    split.backfill(query, other, at_once=3)
    assert text(slices.read_slices(spark, other).select(*nested.batch(query).columns)) == want


def test_a_slice_that_has_grown_is_written_again(spark, chains, tmp_path):
    nested, path = chains[0], str(tmp_path / "table")
    query = BatchQuery("blocks", 0, 20, blocks_per_partition=16)
    nested.backfill(query, path)
    assert [(c.begin, c.end, c.processed) for c in slices.commits(spark, path).values()] == [(0, 16, 14), (16, 20, 4)]
    made = nested.backfill(replace(query, end_height=30), path)
    assert (made.written, made.skipped, made.processed) == (1, 1, 14)
    assert slices.processed(spark, path) == 28
    assert slices.read_slices(spark, path).count() == 28


def test_unchecked_and_streamed_backfills_are_counted(spark, chains, tmp_path):
    nested = chains[0]
    holes = Ledger("ethereum", "mainnet", {"evm": nested.blocks["evm"].where("header.number % 5 > 0")}, None, ChainMetadata(2, 3))
    query = BatchQuery("blocks", 0, 20, blocks_per_partition=8)
    with pytest.raises(NotFound):
        holes.backfill(query, str(tmp_path / "a"))
    assert holes.backfill(query, str(tmp_path / "b"), check=False).processed == 15
    stream = StreamQuery("streamed_blocks", events_per_partition=10)
    made = nested.backfill(stream, str(tmp_path / "c"))
    assert made.processed == nested.events.count() == slices.processed(spark, str(tmp_path / "c"))


# --- streams ---------------------------------------------------------------------------


def follow(spark, root, checkpoint, start=None, **options):
    stream_table(
        "ethereum",
        TableKey("streamed_transactions"),
        stream_events(spark, f"{root}/events", start=start, max_files=1),
        lambda session: read_blocks(session, f"{root}/blocks"),
        f"{root}/table",
        f"{root}/{checkpoint}",
        partition_by_size=4,
        **options,
    ).trigger(availableNow=True).start().awaitTermination()


def land_all(spark, root, rows, files):
    blocks(spark, evm_rows(range(1, 40))).write.parquet(f"{root}/blocks")
    for part in range(files):
        events(spark, rows[part::files]).coalesce(1).write.mode("append").parquet(f"{root}/events")


@pytest.mark.parametrize("size", [None, 7])
def test_overlapping_runs_give_every_event_once(spark, tmp_path, size):
    root, rows = str(tmp_path), log(5, range(1, 40))
    land_all(spark, root, rows, 3)  # files whose sequences interleave
    follow(spark, root, "first", events_per_part=size)
    follow(spark, root, "second", start=20, events_per_part=size)
    follow(spark, root, "third", start=30, events_per_part=size)
    source = read_blocks(spark, f"{root}/blocks")
    want = replay("ethereum", TableKey("streamed_transactions"), events(spark, rows), source, partition_by_size=4)
    assert read_table(spark, f"{root}/table").count() > want.count()
    for schema in (None, want.schema):
        got = read_streamed(spark, f"{root}/table", schema)
        assert text(got.select(*want.columns)) == text(want)
    # What was begun and not finished isn't read.
    run = finished_batches(spark, f"{root}/table")[0].run
    begun = want.limit(3).withColumn("part", F.lit(0)) if size else want.limit(3)
    keys = ["part", "_partition_by"] if size else ["_partition_by"]
    begun.write.partitionBy(*keys).parquet(f"{root}/table/run={run}/batch_id=99")
    assert text(read_streamed(spark, f"{root}/table").select(*want.columns)) == text(want)


def test_parts_bound_what_a_single_file_brings(spark, tmp_path):
    root, rows = str(tmp_path), log(5, range(1, 40))
    land_all(spark, root, rows, 1)
    follow(spark, root, "first", events_per_part=6)
    written = read_table(spark, f"{root}/table")
    spans = written.groupBy("part").agg(F.min("_sequence_number"), F.max("_sequence_number"), F.countDistinct("_sequence_number"))
    for part, low, high, count in spans.collect():
        assert part % 6 == 0 and part <= low and high < part + 6 and count <= 6
    assert len({r.batch_id for r in written.select("batch_id").collect()}) == 1
    with pytest.raises(InvalidArgument, match="parts of 6"):
        follow(spark, root, "second", events_per_part=7)


# --- the session's catalog -------------------------------------------------------------


def test_tables_of_the_catalog(spark, chains, tmp_path):
    nested, root = chains[0], str(tmp_path / "tables")
    query = BatchQuery("transactions", 2, 20, partition_by_size=10)
    path = table_path(root, TableKey("transactions"))
    write_table(nested.batch(query), path)
    [name] = create_tables(spark, root, "ethereum", "mainnet", prefix="kept_")
    try:
        assert name == "default.kept_transactions" and name in {f"default.{t.name}" for t in spark.catalog.listTables()}
        rows = nested.batch(query).count()
        records, size = table_size(spark, name)
        assert records == rows == spark.table(name).count() and size > 0
        about = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE {name}").collect()}
        wanted = {f.name: f.metadata.get("comment") for f in nested.schema("transactions")}
        assert {c: about[c] for c in wanted} == wanted
        part = spark.sql(f"SELECT transaction_hash FROM {name} WHERE _partition_by >= 10")
        assert "PartitionFilters: [isnotnull(_partition_by" in plan(part)
        # Rows that come later show once the table is refreshed.
        write_table(nested.batch(replace(query, start_height=20, end_height=30)), path, mode="append")
        assert table_size(spark, name)[0] == rows
        assert create_tables(spark, root, "ethereum", "mainnet", prefix="kept_") == [name]
        assert table_size(spark, name)[0] == spark.table(name).count() > rows
        listing = list_tables(spark, "ethereum", "mainnet", database="default", prefix="kept_").collect()
        known = {r.table_key: r.total_records for r in listing if r.total_records >= 0}
        assert known == {str(TableKey("transactions")): table_size(spark, name)[0]} and len(listing) > 1
    finally:
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(NotFound):
        refresh_table(spark, name)


def test_a_store_of_many_blocks_has_many_buckets(spark):
    """What a task reads stays the same, and files grow with the blocks."""
    for blocks_, size, buckets in ((0, 50, 8), (1600, 50, 8), (3_200_000, 100_000, 32), (6_400_000, 200_000, 64)):
        heights = spark.range(blocks_).withColumnRenamed("id", "height")
        found, wanted = store_sizes(heights, 50, height="height")
        assert (found, wanted) == (size, buckets)
    sparse = spark.createDataFrame([(5,), (7_000_000,), (None,)], "height BIGINT")
    assert store_sizes(sparse, 1000, height="height") == (219_000, 8)
