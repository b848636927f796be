"""Streamed tables from an event log that keeps growing.

Every micro-batch resolves its events against blocks read at that moment: a
static frame joined to a stream would keep the file list of its start and never
see blocks that land later. Blocks must land before the events that name them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from blockloom.builders import block_family, build, build_split
from blockloom.errors import InvalidArgument, NotFound
from blockloom.metrics import count_blocks
from blockloom.operators.events import EventStats, event_stats, require_blocks, resolve_events
from blockloom.plans.ranges import (
    EARLIEST,
    LATEST,
    event_bounds,
    event_position,
    resolve_stream_range,
)
from blockloom.schemas.inputs import HASH, HEIGHT
from blockloom.schemas.tables import SEQUENCE_NUMBER, TableKey
from blockloom.sinks.files import create, names
from blockloom.sinks.layout import keep_size, note, read_note, read_table, write_part
from blockloom.sinks.slices import Progress, keep_slices, write_slices
from blockloom.sources.blocks import BlockStore, SplitStore
from blockloom.sources.events import EventStore, scan_events

RUN, BATCH_ID, PART = "run", "batch_id", "part"
RUN_NOTE, PART_NOTE = "blockloom_run", "_events_per_part"
# The log of finished micro-batches, and the sequences that each has covered.
BATCHES, COVERED = "_batches", "_covered"
EVENTS_PER_BACKFILL = 100_000


def start_position(events: DataFrame | EventStore, position: str | int) -> int:
    """First sequence to read: a number, EARLIEST, or LATEST (the last event there is)."""
    if isinstance(position, int):
        return position
    if position not in (EARLIEST, LATEST):
        raise InvalidArgument(f"not a position of an event log: {position}")
    return event_position(events, position)


def streamed_table(
    chain: str,
    key: TableKey,
    events: DataFrame,
    blocks: DataFrame | BlockStore | SplitStore,
    *,
    seen: Observation | None = None,
    stats: EventStats | None = None,
    **options,
) -> DataFrame:
    """A streamed table from a bounded slice of events; ``seen`` counts them. ``stats``
    are the slice's, if they have been measured."""
    if not key.streamed:
        raise InvalidArgument(f"not a streamed table: {key}")
    family = block_family(chain, key)
    stats = stats or event_stats(events)
    split = isinstance(blocks, SplitStore)
    store = blocks.heights() if split else BlockStore.of(blocks)
    if seen is not None:
        require_blocks(
            events,
            store,
            height=store.height or HEIGHT[family],
            block_hash=store.block_hash or HASH[family],
            stats=stats,
        )
        events = count_blocks(events, seen)
    if split:
        resolved = resolve_events(
            events, blocks.rows(), headers=blocks.headers, stats=stats, check=seen is None
        )
        return build_split(chain, key, resolved, blocks.headers, **options)
    resolved = resolve_events(events, store, family=family, stats=stats, check=seen is None)
    return build(chain, key, resolved, **options)


def replay(
    chain: str,
    key: TableKey,
    events: DataFrame | EventStore,
    blocks: DataFrame | BlockStore,
    start: int = 0,
    end: int = 0,
    **options,
) -> DataFrame:
    """The part ``[start, end)`` of the event log, clamped to it, as a batch."""
    span = resolve_stream_range(events, start, end)
    return streamed_table(
        chain, key, scan_events(events, span.start, span.end), blocks, **options
    )


def backfill(
    chain: str,
    key: TableKey,
    events: DataFrame | EventStore,
    blocks: DataFrame | BlockStore | SplitStore,
    path: str,
    start: int = 0,
    end: int = 0,
    *,
    events_per_slice: int = EVENTS_PER_BACKFILL,
    at_once: int = 4,
    partition_by_size: int = 0,
    **options,
) -> Progress:
    """Write a long replay slice by slice, ``at_once`` of them at a time.

    The events of one slice are few enough to be broadcast and their heights lie
    close together, so each slice reads its own part of the blocks and shuffles
    only what it writes; one replay of the whole log would shuffle all blocks to
    join them.

    Slices begin at multiples of their size, each in its own ``slice=<start>``
    directory, and are always written whole, as far as the log goes, also where the
    range begins or ends inside one. What is finished is logged beside the table: a run
    that is repeated writes only what is not, and a slice that has grown with the log
    replaces itself and nothing else. The sizes are stored with the table; others are
    refused. ``sinks.slices.read_slices`` reads it.
    """
    spark = events.spark if isinstance(events, EventStore) else events.sparkSession
    path = path.rstrip("/")
    first, last = event_bounds(events)
    span = resolve_stream_range(events, start, end)
    keep_slices(spark, path, events_per_slice, f"{chain}:{key}")
    keep_size(spark, path, partition_by_size)

    def write(begin: int, stop: int, directory: str) -> int:
        part = scan_events(events, max(begin, first), stop)
        stats = event_stats(part)
        table = streamed_table(
            chain, key, part, blocks, stats=stats, partition_by_size=partition_by_size, **options
        )
        write_part(table, directory)
        return stats.count

    begins = range(span.start - span.start % events_per_slice, span.end, events_per_slice)
    return write_slices(
        spark, path, iter(begins), lambda begin: min(begin + events_per_slice, last + 1), write, at_once
    )


def stream_table(
    chain: str,
    key: TableKey,
    events: DataFrame,
    read_blocks: Callable[[SparkSession], DataFrame | BlockStore],
    path: str,
    checkpoint: str,
    *,
    partitions: int | None = None,
    compression: str = "zstd",
    shuffle: bool = True,
    partition_by_size: int = 0,
    events_per_part: int | None = None,
    **options,
) -> DataStreamWriter:
    """A writer, ready to be given a trigger and started.

    ``read_blocks`` is called for every micro-batch and must list the store anew.
    Each micro-batch owns a directory ``run=<run>/batch_id=<id>`` and overwrites it, so
    a batch that Spark repeats after a failure leaves no double rows. The run is a name
    kept in the checkpoint: a new checkpoint, which counts batches from 0 again, writes
    beside what others have written, never over it. A finished batch is logged with the
    sequences that it covers; :func:`read_streamed` sees finished batches alone, and
    every event once, also where runs overlap.

    ``events_per_part`` bounds what is resolved and written at a time, whatever a trigger
    brings, a single large file included: a micro-batch is worked off in order, in parts
    that begin at multiples of it, each a directory of its own. The number is stored with
    the table.
    ``shuffle=False`` writes the rows where the join leaves them.
    The query's progress has the number of events as ``blocks_processed``.
    """
    spark, path = events.sparkSession, path.rstrip("/")
    if events_per_part is not None and events_per_part <= 0:
        raise InvalidArgument(f"parts must have events: {events_per_part}")
    keep_size(spark, path, partition_by_size)
    wanted = str(events_per_part or 0)
    kept = note(spark, path, PART_NOTE, wanted)
    if kept != wanted:
        raise InvalidArgument(f"{path} has parts of {kept} events, not of {wanted}")
    run = note(spark, checkpoint, RUN_NOTE, f"r{uuid.uuid4().hex}")

    def write_one(part: DataFrame, session: SparkSession, directory: str) -> None:
        table = streamed_table(
            chain, key, part, read_blocks(session), partition_by_size=partition_by_size, **options
        )
        write_part(table, directory, partitions, compression, shuffle)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Measured, checked and joined: read the few columns of the events once.
        batch = batch.persist()
        session = batch.sparkSession
        try:
            low, high, count = batch.agg(
                F.min("sequence_num"), F.max("sequence_num"), F.count(F.lit(1))
            ).first()
            directory = f"{path}/{RUN}={run}/{BATCH_ID}={batch_id}"
            if not count:
                return
            if events_per_part is None:
                write_one(batch, session, directory)
            else:
                begin = F.floor(F.col("sequence_num") / events_per_part) * events_per_part
                # No more parts than events; those of one part are dense unless the log isn't.
                begins = batch.select(begin.alias("begin")).distinct().orderBy("begin").collect()
                for row in begins:
                    part = scan_events(batch, row["begin"], row["begin"] + events_per_part)
                    write_one(part, session, f"{directory}/{PART}={row['begin']}")
            covered = batch.select("sequence_num").distinct()
            covered.write.mode("overwrite").parquet(f"{path}/{COVERED}/{RUN}={run}/{BATCH_ID}={batch_id}")
            create(session, f"{path}/{BATCHES}/{run}-{batch_id}-{low}-{high}-{count}", "")
        finally:
            batch.unpersist()

    return (
        count_blocks(events)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"{chain}:{key}:{path}")
        .foreachBatch(write)
    )


@dataclass(frozen=True)
class FinishedBatch:
    """A micro-batch in the log of a streamed table: sequences ``low`` to ``high``."""

    run: str
    batch_id: int
    low: int
    high: int
    events: int


def finished_batches(spark: SparkSession, path: str) -> list[FinishedBatch]:
    found = []
    for name in names(spark, f"{path.rstrip('/')}/{BATCHES}"):
        run, dash, rest = name.partition("-")
        if dash and not name.startswith("."):
            found.append(FinishedBatch(run, *map(int, rest.split("-"))))
    return found


def _shared(batches: list[FinishedBatch]) -> list[tuple[int, int]]:
    """Where what runs have covered, each from its first to its last sequence, overlaps."""
    spans: dict[str, tuple[int, int]] = {}
    for batch in batches:
        low, high = spans.get(batch.run, (batch.low, batch.high))
        spans[batch.run] = min(low, batch.low), max(high, batch.high)
    shared: list[tuple[int, int]] = []
    reached = None
    for low, high in sorted(spans.values()):
        if reached is not None and low <= reached:
            overlap = low, min(high, reached)
            if shared and overlap[0] <= shared[-1][1]:
                overlap = shared[-1][0], max(shared.pop()[1], overlap[1])
            shared.append(overlap)
        reached = high if reached is None else max(reached, high)
    return shared


def read_streamed(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A streamed table with every event once.

    Micro-batches that were begun and not finished are left out. Where runs with
    checkpoints of their own have covered the same sequences, an event's rows come from
    one of them, by the sequences that each has logged; elsewhere nothing is joined.
    """
    path = path.rstrip("/")
    batches = finished_batches(spark, path)
    if not batches:
        raise NotFound(f"{path} has no finished micro-batch")
    if schema is not None:
        keys = [T.StructField(RUN, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
        if int(read_note(spark, path, PART_NOTE) or 0):
            keys.append(T.StructField(PART, T.LongType()))
        schema = T.StructType([*schema.fields, *keys])
    table = read_table(spark, path, schema)
    done: dict[str, set[int]] = {}
    for batch in batches:
        done.setdefault(batch.run, set()).add(batch.batch_id)
    for name in names(spark, path):
        key, _, run = name.partition("=")
        if key == RUN:
            held = {int(n.partition("=")[2]) for n in names(spark, f"{path}/{name}") if n.startswith(f"{BATCH_ID}=")}
            if unfinished := sorted(held - done.get(run, set())):
                table = table.where(~((F.col(RUN) == run) & F.col(BATCH_ID).isin(unfinished)))
    sequence = F.col(SEQUENCE_NUMBER)
    for low, high in _shared(batches):
        covered = spark.read.schema(f"sequence_num BIGINT, {RUN} STRING, {BATCH_ID} BIGINT").parquet(f"{path}/{COVERED}")
        finished = spark.createDataFrame([(b.run, b.batch_id) for b in batches], f"{RUN} STRING, {BATCH_ID} BIGINT")
        owners = (
            covered.where(F.col("sequence_num").between(low, high))
            .join(finished, [RUN, BATCH_ID])
            .groupBy(F.col("sequence_num").alias("__sequence"))
            .agg(F.min(RUN).alias("__owner"))
        )
        inside = sequence.between(low, high)
        own = (sequence == F.col("__sequence")) & (F.col(RUN) == F.col("__owner"))
        table = table.where(~inside).unionByName(table.where(inside).join(owners, own, "left_semi"))
    return table.drop(RUN, BATCH_ID, PART)
