from __future__ import annotations

import os
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from blockloom import (
    BatchQuery,
    ChainMetadata,
    InvalidArgument,
    Ledger,
    NotFound,
    StreamQuery,
    TableKey,
)
from blockloom.metrics import count_blocks
from blockloom.builders import register_builder
from blockloom.operators.evm import evm_blocks, evm_transactions
from blockloom.plans.catalog import list_tables, register_tables, table_path
from blockloom.session import work_dir
from blockloom.sinks.layout import arrange, read_table, write_table
from blockloom.sources.blocks import BlockStore, read_blocks, scan_blocks
from tests.fixtures import blocks, events, evm_block, evm_transaction, rosetta_block


@pytest.fixture(scope="module")
def chain(spark):
    rows = [evm_block(n, [evm_transaction(n, i) for i in range(3)]) for n in range(40)]
    return blocks(spark, rows).cache()


@pytest.mark.parametrize("options", [{}, {"partitions": 3}, {"shuffle": False}])
def test_round_trip(spark, chain, tmp_path, options):
    path = str(tmp_path / "table")
    table = evm_transactions(chain, partition_by_size=10)
    write_table(table, path, **options)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [
        f"_partition_by={n}" for n in (0, 10, 20, 30)
    ]
    again = read_table(spark, path, table.schema).select(*table.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))


def test_reading_a_range_skips_directories(spark, chain, tmp_path):
    path = str(tmp_path / "table")
    table = evm_transactions(chain, columns=["transaction_hash"], partition_by_size=10)
    write_table(table, path)
    part = read_table(spark, path, table.schema, start=15, end=30, partition_by_size=10)
    assert sorted({r[0] for r in part.select("_repartition_by_range").collect()}) == list(
        range(15, 30)
    )
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "_partition_by" in filters and "10" in filters and "20" in filters
    assert "GreaterThanOrEqual(_repartition_by_range,15)" in plan
    with pytest.raises(InvalidArgument):
        read_table(spark, path, start=5, end=5)


def test_the_stored_size_prunes_and_a_wrong_one_is_refused(spark, chain, tmp_path):
    for size in (0, 20):
        path = str(tmp_path / f"by-{size}")
        table = evm_transactions(chain, columns=["transaction_hash"], partition_by_size=size)
        write_table(table, path)
        with pytest.raises(InvalidArgument, match=f"partitioned by {size}"):
            read_table(spark, path, start=20, end=40, partition_by_size=10)
        part = read_table(spark, path, start=30, end=40)
        assert part.count() == 30
        other = evm_transactions(chain, columns=["transaction_hash"], partition_by_size=10)
        with pytest.raises(InvalidArgument, match=f"partitioned by {size}"):
            write_table(other, path, mode="append")
        assert read_table(spark, path).count() == 120


def test_the_layout_samples_nothing(spark, chain):
    for columns in (["transaction_hash"], ["value"]):
        table = evm_transactions(chain, columns=columns, partition_by_size=10)
        plan = arrange(table)._jdf.queryExecution().toString()
        assert "rangepartitioning" not in plan and "hashpartitioning(_partition_by" in plan
    rows = [evm_block(1, [evm_transaction(1, i, value=str(i)) for i in range(3000)])]
    table = evm_transactions(blocks(spark, rows), columns=["value"], partition_by_size=10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = arrange(table).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1


def _dealt(spark, table):
    """Tasks and rows by directory and height, without small tasks being put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = arrange(table).withColumn("task", F.spark_partition_id())
        return rows.groupBy("_partition_by").agg(F.countDistinct("task").alias("tasks"), F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_directory_is_one_file_unless_a_block_is_huge(spark, chain, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for table in (evm_transactions(chain, partition_by_size=10), evm_blocks(chain, partition_by_size=10)):
            dealt = _dealt(spark, table)
            assert len(dealt) == 4 and {r["tasks"] for r in dealt} == {1}
        huge = [evm_block(1, [{"index": i, "hash": f"t{i}"} for i in range(60_000)])]
        table = evm_transactions(blocks(spark, huge), columns=["transaction_index"], partition_by_size=10)
        [row] = _dealt(spark, table)
        assert row["n"] == 60_000 and row["tasks"] > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_huge_block_is_cut_up(spark):
    rows = [evm_block(1, [evm_transaction(1, i) for i in range(3000)])]
    rows += [evm_block(n, [evm_transaction(n, 0)]) for n in range(2, 50)]
    table = evm_transactions(blocks(spark, rows), columns=["transaction_hash", "transaction_index"])
    parts = arrange(table, 6).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 6
    assert max(r["count"] for r in parts) < 1500


def test_scan_reaches_the_files(spark, chain, tmp_path):
    path = str(tmp_path / "blocks")
    chain.withColumn("bucket", F.expr("header.number div 10 * 10")).write.partitionBy(
        "bucket"
    ).parquet(path)
    stored = spark.read.parquet(path)
    part = scan_blocks(stored, 15, 30, bucket_column="bucket", bucket_size=10)
    assert part.count() == 15
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(header.number,15)" in plan
    assert "bucket" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_views(spark, chain, tmp_path):
    root = str(tmp_path)
    key = TableKey("transactions")
    write_table(evm_transactions(chain, partition_by_size=10), table_path(root, key))
    assert register_tables(spark, root, "ethereum", "mainnet", prefix="v_") == ["v_transactions"]
    assert spark.sql("SELECT count(*) FROM v_transactions WHERE block.number < 5").first()[0] == 15


def test_listing(spark):
    listed = {r.table_key: r for r in list_tables(spark, "ethereum", "mainnet").collect()}
    assert len(listed) == 8
    row = listed["table=blocks/format=native/encoding=none"]
    assert (row.columns, row.total_records, row.total_bytes) == (26, -1, -1)
    assert list_tables(spark, "bsc", "mainnet").count() == 5


def test_blocks_are_counted(chain):
    seen = Observation()
    evm_transactions(count_blocks(chain, seen), columns=["transaction_hash"]).collect()
    assert seen.get == {"blocks_processed": 40}


def session(folder=None, checkpoints=None):
    """Just the two things that are read from a session."""
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    return SimpleNamespace(
        conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: checkpoints)
    )


def test_work_dir_is_below_the_shared_folder():
    shared = session("/shared/", "/other")
    made = work_dir(shared, "x")
    assert made.startswith("/shared/x-") and made != work_dir(shared, "x")
    assert work_dir(session(None, "/set"), "x").startswith("/set/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session(), "x")


@pytest.fixture(scope="module")
def ledger(spark, chain):
    log = events(spark, [(n + 5, "BLOCK_ADDED", 1, n, f"b{n}") for n in range(40)])
    neutral = [
        rosetta_block(n, [{"transaction_identifier": {"hash": f"t{n}"}}]) for n in range(40)
    ]
    sources = {"evm": chain, "rosetta": blocks(spark, neutral, "rosetta")}
    return Ledger("ethereum", "mainnet", sources, log, ChainMetadata(2, 9))


def test_ledger_positions(ledger):
    assert (ledger.tip(), ledger.earliest()) == (30, 2)
    assert (ledger.stream_tip(), ledger.stream_earliest()) == (44, 5)
    assert len(ledger.tables()) == 8 and ledger.list_tables().count() == 8
    assert len(ledger.schema("blocks")) == 26


def test_ledger_refuses_gaps_and_lost_headers(spark, chain):
    def ledger_of(frame):
        return Ledger("bsc", "mainnet", {"evm": frame}, None, ChainMetadata(0, 0))

    gap = ledger_of(chain.where("header.number <> 7"))
    with pytest.raises(NotFound, match="1 blocks are missing.*first 7"):
        gap.batch(BatchQuery("blocks", 0, 20))
    assert gap.batch(BatchQuery("blocks", 0, 20), check=False).count() == 19
    assert gap.batch(BatchQuery("blocks", 10, 20)).count() == 10
    with pytest.raises(NotFound, match="960 blocks are missing"):
        ledger_of(chain).batch(BatchQuery("blocks", 0, 1000))
    lost = chain.limit(1).withColumn("header", F.lit(None).cast(chain.schema["header"].dataType))
    with pytest.raises(InvalidArgument, match="1 blocks have no height"):
        ledger_of(chain.unionByName(lost)).batch(BatchQuery("blocks", 0, 20))


def test_ledger_reads_only_the_directories_of_its_range(spark, chain, tmp_path):
    path = str(tmp_path / "blocks")
    chain.withColumn("bucket", F.expr("header.number div 10 * 10")).write.partitionBy(
        "bucket"
    ).parquet(path)
    store = BlockStore(read_blocks(spark, path, bucket_column="bucket"), "bucket", 10)
    log = events(spark, [(5, "BLOCK_ADDED", 1, 3, "b3")])
    ledger = Ledger("bsc", "mainnet", {"evm": store}, log, ChainMetadata(0, 5))
    assert ledger.tip() == 34
    for table, size in ((ledger.batch(BatchQuery("blocks", 12, 18)), 6), (ledger.stream(StreamQuery("streamed_blocks")), 1)):
        assert table.count() == size
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    with pytest.raises(InvalidArgument):
        BlockStore(chain, "bucket")


def test_ledger_counts_blocks_for_each_table(ledger):
    seen = [Observation(), Observation()]
    ledger.batch(BatchQuery("blocks", 10, 35), seen=seen[0]).collect()
    ledger.stream(StreamQuery("streamed_blocks", 10, 13), seen=seen[1]).collect()
    assert [s.get for s in seen] == [{"blocks_processed": 25}, {"blocks_processed": 3}]


def test_ledger_builds_added_tables(spark, chain):
    key = TableKey("heights_of_ledger")
    register_builder("bsc", key, "evm", lambda blocks, **_: blocks.selectExpr("header.number AS n"))
    bare = Ledger("bsc", "mainnet", {"evm": chain}, None, ChainMetadata(0, 0))
    assert bare.batch(BatchQuery("heights_of_ledger", 3, 9)).count() == 6


def test_unsigned_input_past_the_signed_range(spark, tmp_path):
    path, big = str(tmp_path / "blocks"), 2**63 + 11
    value = pa.array([{"number": 1, "hash": "b1", "gas_limit": big}], pa.struct([("number", pa.uint64()), ("hash", pa.string()), ("gas_limit", pa.uint64())]))
    os.makedirs(path)
    pq.write_table(pa.table({"tag": pa.array([1], pa.int64()), "header": value}), f"{path}/a.parquet")
    source = read_blocks(spark, path, u64="decimal")
    made = evm_blocks(source, columns=["hash", "gas_limit"], u64="decimal")
    assert int(made.first()["gas_limit"]) == big
    root, key = str(tmp_path / "tables"), TableKey("blocks")
    write_table(evm_blocks(source, u64="decimal", partition_by_size=10), table_path(root, key))
    assert register_tables(spark, root, "bsc", "mainnet", prefix="d_", u64="decimal") == ["d_blocks"]
    assert int(spark.sql("SELECT max(gas_limit) FROM d_blocks").first()[0]) == big


def test_ledger_batch(ledger):
    assert ledger.batch(BatchQuery("transactions")).count() == 28 * 3
    assert ledger.batch(BatchQuery("blocks", 10, 35)).count() == 25
    neutral = BatchQuery("transactions", 10, 20, format="rosetta", partition_by_size=10)
    assert {r._partition_by for r in ledger.batch(neutral).collect()} == {10}
    slices = ledger.batch_slices(BatchQuery("blocks", blocks_per_partition=10)).collect()
    assert sorted(map(tuple, slices)) == [(2, 12), (12, 22), (22, 30)]


def test_ledger_stream(ledger):
    assert ledger.stream(StreamQuery("streamed_blocks")).count() == 40
    assert ledger.stream(StreamQuery("streamed_transactions", 10, 12)).count() == 6
    raw = StreamQuery("streamed_transactions", format="rosetta", encoding="raw")
    assert ledger.stream(raw).count() == 40
    slices = ledger.stream_slices(StreamQuery("streamed_blocks", events_per_partition=30))
    assert sorted(map(tuple, slices.collect())) == [(5, 35), (35, 45)]


def test_ledger_refuses(ledger, chain):
    with pytest.raises(NotFound):
        ledger.batch(BatchQuery("nothing"))
    with pytest.raises(InvalidArgument):
        ledger.batch(BatchQuery("streamed_blocks"))
    with pytest.raises(InvalidArgument):
        ledger.stream(StreamQuery("blocks"))
    with pytest.raises(InvalidArgument):
        ledger.batch(BatchQuery("blocks", 20, 20))
    bare = Ledger("bsc", "mainnet", {"evm": chain})
    with pytest.raises(NotFound):
        bare.batch(BatchQuery("transactions", format="rosetta"))
    with pytest.raises(NotFound):
        bare.stream(StreamQuery("streamed_blocks"))
