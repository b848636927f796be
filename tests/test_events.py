from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from blockloom import InvalidArgument, NotFound
from blockloom.demo import ledger, queries
from blockloom.operators.events import event_stats, missing_blocks, resolve_events
from blockloom.operators.evm import (
    evm_blocks,
    evm_raw_transactions,
    evm_split_transactions,
    evm_transactions,
)
from blockloom.operators.rosetta import rosetta_raw_transactions
from blockloom.sources.blocks import BlockStore, read_blocks
from tests.fixtures import blocks, events, evm_block, evm_transaction, rosetta_block

ADDED, REMOVED = "BLOCK_ADDED", "BLOCK_REMOVED"


@pytest.fixture(params=["broadcast", "shuffle"])
def stats_of(request):
    def stats(log):
        found = event_stats(log)
        assert found.fits_broadcast
        if request.param == "shuffle":
            return dataclasses.replace(found, bytes=1 << 40)
        return found

    return stats


@pytest.fixture(scope="module")
def chain(spark):
    rows = [evm_block(n, [evm_transaction(n, i) for i in range(n % 3)]) for n in range(1, 7)]
    rows.append(evm_block(2, [evm_transaction(2, 9)], tag=2))
    return blocks(spark, rows).cache()


LOG = [
    (10, ADDED, 1, 1, "b1"),
    (11, ADDED, 1, 2, "b2"),
    (12, REMOVED, 1, 2, "b2"),
    (13, None, 2, 2, "b2"),
    (14, ADDED, 1, 3, "b3"),
]


def test_event_stats(spark):
    stats = event_stats(events(spark, LOG))
    assert (stats.count, stats.min_height, stats.max_height) == (5, 1, 3)
    empty = event_stats(events(spark, LOG).limit(0))
    assert (empty.count, empty.min_height) == (0, None)


def test_a_block_serves_many_events(spark, chain, stats_of):
    log = events(spark, LOG)
    table = evm_blocks(resolve_events(log, chain, stats=stats_of(log)), partition_by_size=4)
    got = sorted(table.select("_sequence_number", "_event_type", "number", "_partition_by",
                              "_repartition_by_range").collect())
    assert [tuple(r) for r in got] == [
        (10, ADDED, 1, 8, 10),
        (11, ADDED, 2, 8, 11),
        (12, REMOVED, 2, 12, 12),
        (13, "UNKNOWN", 2, 12, 13),
        (14, ADDED, 3, 12, 14),
    ]


def test_streamed_transactions_respect_the_tag(spark, chain, stats_of):
    log = events(spark, LOG)
    table = evm_transactions(resolve_events(log, chain, stats=stats_of(log)))
    got = sorted(map(tuple, table.select("_sequence_number", "transaction_hash").collect()))
    assert got == [
        (10, "t1-0"),
        (11, "t2-0"),
        (11, "t2-1"),
        (12, "t2-0"),
        (12, "t2-1"),
        (13, "t2-9"),
    ]


@pytest.mark.parametrize(
    "bad", [(20, ADDED, 1, 99, "b99"), (20, ADDED, 3, 2, "b2"), (20, ADDED, 1, 3, "fork")]
)
def test_a_missing_block_is_refused(spark, chain, stats_of, bad):
    log = events(spark, [*LOG, bad])
    with pytest.raises(NotFound, match=r"no block for an event.*event 20"):
        resolve_events(log, chain, stats=stats_of(log))
    rest = resolve_events(log, chain, stats=stats_of(log), check=False)
    assert rest.count() == len(LOG)


def test_missing_blocks_are_listed(spark, chain, stats_of):
    log = events(spark, [*LOG, (20, None, 1, 99, "b99")])
    missing = missing_blocks(log, chain, stats=stats_of(log))
    assert [tuple(r) for r in missing.collect()] == [(20, None, 1, 99, "b99")]


def test_repeated_and_lost_sequences_do_not_hide_a_missing_block(spark, chain, stats_of):
    log = events(
        spark,
        [(1, ADDED, 1, 3, "b3"), (1, ADDED, 1, 77, "b77"), (None, ADDED, 1, 4, "b4"), (2, ADDED, 1, None, "b1")],
    )
    missing = missing_blocks(log, chain, stats=stats_of(log))
    assert sorted(map(str, map(tuple, missing.collect()))) == sorted(
        map(str, [(1, ADDED, 1, 77, "b77"), (2, ADDED, 1, None, "b1")])
    )
    good = log.where("block.hash in ('b3', 'b4')")
    assert resolve_events(good, chain, stats=stats_of(good)).count() == 2


def test_a_block_stored_twice_is_refused(spark, chain, stats_of):
    log, twice = events(spark, LOG), chain.union(chain.where("header.number = 3"))
    with pytest.raises(InvalidArgument, match="2 stored blocks.*hash b3"):
        resolve_events(log, twice, stats=stats_of(log))
    rest = events(spark, LOG[:4])
    assert resolve_events(rest, twice, stats=stats_of(rest)).count() == 4


def test_only_the_directories_that_events_name_are_read(spark, chain, tmp_path):
    path = str(tmp_path / "blocks")
    rows = blocks(spark, [evm_block(n) for n in range(100)])
    rows.withColumn("bucket", F.expr("header.number div 10 * 10")).write.partitionBy("bucket").parquet(path)
    store = BlockStore(read_blocks(spark, path, bucket_column="bucket"), "bucket", 10)
    log = events(spark, [(1, ADDED, 1, 3, "b3"), (2, ADDED, 1, 95, "b95")])
    resolved = resolve_events(log, store)
    assert resolved.count() == 2
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "bucket" in filters and "IN (0,90)" in filters


def test_no_events_no_rows(spark, chain):
    log = events(spark, LOG).limit(0)
    assert resolve_events(log, chain).count() == 0


def test_split_layout(spark, chain, stats_of):
    keys = ["tag", F.col("header.number").alias("height"), F.col("header.hash").alias("hash")]
    headers = chain.select(*keys, "header")
    split = chain.select(*keys, F.explode("transactions").alias("transaction"))
    log = events(spark, LOG)
    resolved = resolve_events(
        log, split, height="height", block_hash="hash", headers=headers, stats=stats_of(log)
    )
    got = evm_split_transactions(resolved, headers, partition_by_size=4)
    want = evm_transactions(resolve_events(log, chain), partition_by_size=4)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    bad = events(spark, [(20, ADDED, 1, 99, "b99")])
    with pytest.raises(NotFound, match="no block for an event"):
        resolve_events(
            bad, split, height="height", block_hash="hash", headers=headers, stats=stats_of(bad)
        )


def test_one_block_with_most_of_the_events(spark, chain, stats_of):
    log = events(spark, [(i, ADDED, 1, 2, "b2") for i in range(2000)] + LOG[:1])
    table = evm_transactions(resolve_events(log, chain, stats=stats_of(log)))
    assert table.count() == 4001


def test_small_slices_do_not_shuffle_blocks(spark, tmp_path):
    path = str(tmp_path / "blocks")
    blocks(spark, [evm_block(n, [evm_transaction(n, 0)]) for n in range(50)]).write.parquet(path)
    log = events(spark, LOG[:1])
    plan = (
        resolve_events(log, spark.read.parquet(path))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "BroadcastHashJoin" in plan
    assert "GreaterThanOrEqual(header.number,1)" in plan
    assert "LessThanOrEqual(header.number,1)" in plan


def test_raw_transactions(spark, chain):
    log = events(spark, LOG[:2])
    table = evm_raw_transactions(resolve_events(log, chain), partition_by_size=4)
    got = sorted(table.collect(), key=lambda r: (r[0], r[3]))
    assert [(r[0], r.transaction_hash, r.transaction_index) for r in got] == [
        (10, "t1-0", 0),
        (11, "t2-0", 0),
        (11, "t2-1", 1),
    ]
    for row in got:
        assert json.loads(bytes(row.transaction_data))["hash"] == row.transaction_hash


def test_rosetta_raw_transactions_need_no_members(spark):
    bare = rosetta_block(3, [{}, {"transaction_identifier": {"hash": "t"}}])
    bare["timestamp"] = bare["parent_block_identifier"] = None
    source = blocks(spark, [bare], "rosetta")
    log = events(spark, [(5, REMOVED, 1, 3, "b3")])
    table = rosetta_raw_transactions(resolve_events(log, source, family="rosetta"))
    got = sorted(table.collect(), key=lambda r: r.transaction_index)
    assert [r.transaction_index for r in got] == [0, 1]
    info = got[0].block_info.asDict(recursive=True)
    assert info == {
        "block_identifier": {"index": 3, "hash": "b3"},
        "parent_identifier": {"index": 0, "hash": ""},
        "timestamp": 0,
    }
    assert json.loads(bytes(got[1].transaction_data)) == {"transaction_identifier": {"hash": "t"}}


def test_rows_built_before_the_event_join(spark, tmp_path):
    """The streamed query gives what the builder gives for resolved blocks, and shuffles no lists."""
    seconds = "TIMESTAMP '2024-01-01 00:00:00'"
    orders = spark.range(40).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "element_at(array('F', 'O', 'P'), int(id % 3) + 1) AS o_orderstatus",
        "element_at(array('1-URGENT', '2-HIGH'), int(id % 2) + 1) AS o_orderpriority", "id * 1.5D AS o_totalprice", f"{seconds} AS o_orderdate",
    )
    kinds = "element_at(array('signup', 'error', 'click', CAST(NULL AS STRING)), int(id % 4) + 1) AS event_type"
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(40).selectExpr("id AS event_id", kinds).write.parquet(f"{tmp_path}/events.parquet")
    log, nested = ledger.chain_events(spark, str(tmp_path)), ledger.evm_blocks(spark, str(tmp_path))
    whole = evm_transactions(resolve_events(log, nested), partition_by_size=queries.PARTITION_SIZE)
    want = queries._flat_transactions(whole, "_sequence_number", "_event_type")
    got = queries.evm_streamed_transactions(spark, str(tmp_path))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 20
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("size(")


def test_a_large_log_lands_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LANDED", 10)
    log = spark.range(35).select(F.col("id").alias("sequence_num"))
    queries._land(log, f"{tmp_path}/events")
    files = [spark.read.parquet(str(p)).count() for p in (tmp_path / "events").glob("*.parquet")]
    assert len(files) == 4 and sum(files) == 35 and max(files) < 20
    queries._land(log.limit(10), f"{tmp_path}/events")
    assert len(list((tmp_path / "events").glob("*.parquet"))) == 5


def test_catalog_shuffles_no_blocks_for_streamed_tables(spark, tmp_path, monkeypatch):
    """Large event logs are joined by a shuffle: of keys, not of all transactions."""
    orders = [(k, k % 3, "FOP"[k % 3], 10.5 * k, f"{1 + k % 5}-URGENT") for k in range(30)]
    spark.createDataFrame(
        orders,
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string",
    ).selectExpr("*", "TIMESTAMP'2020-01-01 00:00:00' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    logged = [(k, ("click", "error", "signup")[k % 3]) for k in range(12)]
    spark.createDataFrame(logged, "event_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr("blockloom.operators.events.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.catalog_tables(spark, str(tmp_path))
        plan = found._jdf.queryExecution().sparkPlan().toString().splitlines()
        rows = {(r.chain, r.table_key): r.rows for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("Join" in line and "transactions#" in after for line, after in zip(plan, plan[1:]))
    sizes = {k: r for k, r in enumerate(
        spark.read.parquet(f"{tmp_path}/orders.parquet").orderBy("o_orderkey").selectExpr(
            "IF(o_orderstatus = 'P', 0, 1) + IF(o_orderstatus = 'F', 1, 0)"
            " + IF(o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT', 1, 0) AS n"
        ).toPandas()["n"]
    )}
    streamed = sum(sizes[max(k - 1, 0) if kind == "error" else k] for k, kind in logged)
    for (_, key), n in rows.items():
        if "streamed_blocks" in key:
            assert n == len(logged)
        elif "streamed" in key:
            assert n == streamed
        else:
            assert n == (len(orders) if "table=blocks" in key else sum(sizes.values()))
    assert len(rows) == 10
