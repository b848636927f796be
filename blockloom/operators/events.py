"""The event join: the block that each chain event talks about."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from blockloom.errors import InvalidArgument, NotFound
from blockloom.operators.rows import EVENT
from blockloom.schemas.inputs import HASH, HEIGHT
from blockloom.sources.blocks import BlockStore

BROADCAST_BYTES = 64 * 1024 * 1024
# A block that more than one in so many events name is joined apart from a bucketed store.
HOT_BLOCKS = 1_000
# Directories that a scan lists by name; the rest of a slice is read as a span.
MAX_BUCKETS = 2_000
# Upper bound of what one event row takes beside its texts, with the hash table's own cost.
_ROW_BYTES = 256


@dataclass(frozen=True)
class EventStats:
    """Exact facts about a slice of events, from one pass over three columns."""

    count: int
    bytes: int
    min_height: int | None
    max_height: int | None

    @property
    def fits_broadcast(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def event_stats(events: DataFrame) -> EventStats:
    texts = F.coalesce(F.octet_length("block.hash"), F.lit(0)) + F.coalesce(
        F.octet_length("type"), F.lit(0)
    )
    row = events.agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(F.sum(texts + _ROW_BYTES), F.lit(0)).alias("bytes"),
        F.min("block.height").alias("low"),
        F.max("block.height").alias("high"),
    ).first()
    assert row is not None
    return EventStats(row["count"], row["bytes"], row["low"], row["high"])


def within_heights(
    blocks: DataFrame | BlockStore, stats: EventStats, height: str, events: DataFrame
) -> DataFrame:
    """Only heights that some event may name; reaches the Parquet scan.

    Of a store with a directory per bucket only the buckets that events name are read,
    so one event of an old height does not open all directories in between. If they
    are too many to list, all from the first to the last are read.
    """
    store = BlockStore.of(blocks)
    if stats.min_height is None:
        return store.frame.where(F.lit(False))
    frame = store.within(stats.min_height, stats.max_height + 1)
    if store.bucket_column is not None:
        number = F.col("block.height")
        bucket = number - number % store.bucket_size
        named = events.where(number.isNotNull()).select(bucket.alias("bucket")).distinct()
        buckets = [row[0] for row in named.limit(MAX_BUCKETS + 1).collect()]
        if len(buckets) <= MAX_BUCKETS:
            frame = store.in_buckets(sorted(buckets))
    return frame.where(F.col(height).between(stats.min_height, stats.max_height))


def _event_keys(events: DataFrame) -> DataFrame:
    return events.select(
        F.struct("sequence_num", "type").alias(EVENT),
        F.col("block.tag").alias("__tag"),
        F.col("block.height").alias("__height"),
        F.col("block.hash").alias("__hash"),
    )


def _same_block(height: str, block_hash: str) -> Column:
    return (
        (F.col("tag") == F.col("__tag"))
        & (F.col(height) == F.col("__height"))
        & (F.col(block_hash) == F.col("__hash"))
    )


_KEYS = ("__tag", "__height", "__hash")


def _block_counts(
    events: DataFrame,
    blocks: DataFrame | BlockStore,
    stats: EventStats,
    height: str,
    block_hash: str,
) -> DataFrame:
    """Every event with ``__blocks``, how many blocks it names; NULL for none.

    Reads and moves only the blocks' key columns. Blocks are cut to the keys that
    events name and counted there; whether these keys are broadcast for it changes
    the plan, not the counts.
    """
    keys = _event_keys(events)
    named = keys.select(*_KEYS).distinct()
    counts = (
        within_heights(blocks, stats, height, events)
        .select("tag", F.col(height).alias("height"), F.col(block_hash).alias("hash"))
        .join(
            F.broadcast(named) if stats.fits_broadcast else named,
            _same_block("height", "hash"),
            "left_semi",
        )
        .groupBy("tag", "height", "hash")
        .agg(F.count(F.lit(1)).alias("__blocks"))
    )
    return keys.join(counts, _same_block("height", "hash"), "left")


def missing_blocks(
    events: DataFrame,
    blocks: DataFrame | BlockStore,
    *,
    family: str = "evm",
    height: str | None = None,
    block_hash: str | None = None,
    stats: EventStats | None = None,
) -> DataFrame:
    """Events whose block is not there: (sequence_num, type, tag, height, hash)."""
    counted = _block_counts(
        events,
        blocks,
        stats or event_stats(events),
        *_key_columns(BlockStore.of(blocks), family, height, block_hash),
    )
    return counted.where(F.col("__blocks").isNull()).select(*_reported())


def _reported() -> list[Column]:
    return [
        F.col(f"{EVENT}.sequence_num"),
        F.col(f"{EVENT}.type"),
        F.col("__tag").alias("tag"),
        F.col("__height").alias("height"),
        F.col("__hash").alias("hash"),
    ]


def require_blocks(
    events: DataFrame,
    blocks: DataFrame | BlockStore,
    *,
    height: str,
    block_hash: str,
    stats: EventStats | None = None,
) -> None:
    """Refuse a slice with an event whose block is missing or stored more than once.

    One job over the keys.
    """
    stats = stats or event_stats(events)
    counted = _block_counts(events, blocks, stats, height, block_hash)
    wrong = counted.where(F.col("__blocks").isNull() | (F.col("__blocks") > 1))
    lost = wrong.select(*_reported(), "__blocks").first()
    if lost is None:
        return
    where = (
        f"tag {lost['tag']}, height {lost['height']}, hash {lost['hash']}; "
        f"event {lost['sequence_num']}"
    )
    if lost["__blocks"] is None:
        raise NotFound(f"no block for an event: {where}")
    raise InvalidArgument(f"{lost['__blocks']} stored blocks for one event: {where}")


def resolve_events(
    events: DataFrame,
    blocks: DataFrame | BlockStore,
    *,
    family: str = "evm",
    height: str | None = None,
    block_hash: str | None = None,
    headers: DataFrame | None = None,
    stats: EventStats | None = None,
    check: bool = True,
) -> DataFrame:
    """The blocks' columns and ``event`` (sequence number, type) for every event.

    A block serves any number of events. Blocks must be unique by (tag, height,
    hash), as in a block store; one that an event names and that is stored twice is
    refused with the missing ones. In the split layout ``blocks`` are the keyed
    transactions and ``headers`` tell which blocks exist (a block may have no
    transactions).

    A missing block is refused before anything is returned (``check``). The same
    check inside the plan would get lost: whoever unnests or filters the result
    turns an outer join into an inner one, and an inner join with an empty side
    is dropped with all that feeds it.

    Blocks are cut to the events' heights first. If the events' measured size
    fits, they are broadcast and the wide blocks are neither shuffled nor
    sorted. Otherwise, in a store that is bucketed by block (``write_block_store``), the
    events alone are shuffled to the buckets of the blocks, which stay where they are;
    blocks that very many events name are joined apart. In other stores both sides
    are shuffled by key, and adaptive execution may split either of them where one
    block has very many events or transactions.
    """
    store = BlockStore.of(blocks)
    height, block_hash = _key_columns(store, family, height, block_hash)
    stats = stats or event_stats(events)
    if check and headers is None:
        require_blocks(events, blocks, height=height, block_hash=block_hash, stats=stats)
    elif check:
        require_blocks(events, headers, height="height", block_hash="hash", stats=stats)
    keys = _event_keys(events)
    inside = within_heights(blocks, stats, height, events)
    same = _same_block(height, block_hash)
    if stats.fits_broadcast:
        return inside.join(F.broadcast(keys), same, "inner").drop(*_KEYS)
    if store.height is None or not (hot := _hot_blocks(keys, stats)):
        return inside.join(keys, same, "inner").drop(*_KEYS)
    # A bucket can't be split: blocks with very many events are joined apart, by a
    # shuffle that can. They are few, see HOT_BLOCKS.
    named = F.broadcast(events.sparkSession.createDataFrame(hot, keys.select(*_KEYS).schema))
    cold = inside.join(keys.join(named, list(_KEYS), "left_anti"), same, "inner")
    heights = sorted({row["__height"] for row in hot})
    few = inside.where(F.col(height).isin(heights)).repartition("tag", height, block_hash)
    warm = few.join(keys.join(named, list(_KEYS), "left_semi"), same, "inner")
    return cold.unionByName(warm).drop(*_KEYS)


def _key_columns(
    store: BlockStore, family: str, height: str | None, block_hash: str | None
) -> tuple[str, str]:
    return height or store.height or HEIGHT[family], block_hash or store.block_hash or HASH[family]


def _hot_blocks(keys: DataFrame, stats: EventStats) -> list[Row]:
    """Blocks that more than one in ``HOT_BLOCKS`` events name: fewer than that many."""
    counted = keys.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__events"))
    return counted.where(F.col("__events") > stats.count / HOT_BLOCKS).select(*_KEYS).collect()
