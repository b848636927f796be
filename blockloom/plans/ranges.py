"""Positions, and how a requested range becomes the range that is read.

Defaults and clamping happen here, once. ``scan_blocks`` and ``scan_events``
take their range as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.errors import InvalidArgument, NotFound
from blockloom.schemas.inputs import HEIGHT
from blockloom.sources.blocks import BlockStore
from blockloom.sources.events import EventStore
from blockloom.sources.metadata import ChainMetadata

# Defaults and limit of the slices a range is cut into.
BLOCKS_PER_SLICE = 100
EVENTS_PER_SLICE = 100
MAX_SLICES = 50_000

# Heights that Spark's bitmap functions keep in one bitmap.
BITMAP = 32_768

EARLIEST, LATEST = "EARLIEST", "LATEST"


@dataclass(frozen=True)
class Range:
    """Half-open: ``start`` is in, ``end`` is not."""

    start: int
    end: int


def tip(
    blocks: DataFrame | BlockStore,
    metadata: ChainMetadata,
    *,
    family: str = "evm",
    height: str | None = None,
) -> int:
    column = height or HEIGHT[family]
    latest = BlockStore.of(blocks).top().agg(F.max(column)).first()[0]
    if latest is None:
        raise NotFound("there is no latest block")
    if latest < metadata.irreversible_distance:
        raise InvalidArgument(
            f"latest height {latest} is below the irreversible distance "
            f"{metadata.irreversible_distance}"
        )
    return int(latest) - metadata.irreversible_distance


def earliest(metadata: ChainMetadata) -> int:
    """Where the chain starts by its configuration, whatever blocks there are."""
    return metadata.block_start_height


def event_position(events: DataFrame | EventStore, position: str) -> int:
    """Sequence of the first or last event; the log must not be empty."""
    extremes = {EARLIEST: F.min, LATEST: F.max}
    if position not in extremes:
        raise InvalidArgument(f"not a position of an event log: {position}")
    if isinstance(events, EventStore):
        return events.first() if position == EARLIEST else events.last()
    sequence = events.agg(extremes[position]("sequence_num")).first()[0]
    if sequence is None:
        raise NotFound("there are no events")
    return sequence


def stream_tip(events: DataFrame | EventStore) -> int:
    return event_position(events, LATEST)


def stream_earliest(events: DataFrame | EventStore) -> int:
    return event_position(events, EARLIEST)


def resolve_batch_range(
    blocks: DataFrame | BlockStore,
    metadata: ChainMetadata,
    start: int = 0,
    end: int = 0,
    *,
    family: str = "evm",
    height: str | None = None,
) -> Range:
    """Heights to read: not before the chain's start; end 0 is the tip.

    An explicit end is kept even past the tip; see :func:`require_complete`.
    """
    if start < 0 or end < 0:
        raise InvalidArgument(f"heights must not be negative: start={start}, end={end}")
    start = max(start, metadata.block_start_height)
    if end == 0:
        end = tip(blocks, metadata, family=family, height=height)
    if end <= start:
        raise InvalidArgument(f"end height must be above start height: {start}, {end}")
    return Range(start, end)


def event_bounds(events: DataFrame | EventStore) -> tuple[int, int]:
    """First and last sequence, in one pass; of a store from its footers."""
    if isinstance(events, EventStore):
        return events.bounds()
    low, high = events.agg(F.min("sequence_num"), F.max("sequence_num")).first()
    if low is None:
        raise NotFound("there are no events")
    return low, high


def resolve_stream_range(events: DataFrame | EventStore, start: int = 0, end: int = 0) -> Range:
    """Sequences to read, clamped to the log at both ends; end 0 is the whole rest."""
    if end < 0:
        raise InvalidArgument(f"end sequence must not be negative: {end}")
    first, last = event_bounds(events)
    if start > last:
        raise InvalidArgument(f"start sequence {start} is after the latest event {last}")
    start = max(start, first)
    if 0 < end <= start:
        raise InvalidArgument(f"end sequence {end} must be greater than start {start}")
    if end == 0 or end > last + 1:
        end = last + 1
    return Range(start, end)


def _slices(spark: SparkSession, span: Range, size: int) -> DataFrame:
    return spark.range(span.start, span.end, size).select(
        F.col("id").alias("slice_start"),
        F.least(F.col("id") + size, F.lit(span.end)).alias("slice_end"),
    )


def _size(requested: int, default: int) -> int:
    if requested < 0:
        raise InvalidArgument(f"slice size must not be negative: {requested}")
    return requested or default


def plan_batch_slices(spark: SparkSession, span: Range, blocks_per_slice: int = 0) -> DataFrame:
    """The range as work units (slice_start, slice_end) of a backfill; size 0 is the default."""
    size = _size(blocks_per_slice, BLOCKS_PER_SLICE)
    count = -(-(span.end - span.start) // size)
    if count > MAX_SLICES:
        raise InvalidArgument(f"{count} slices of {size} blocks are more than {MAX_SLICES}")
    return _slices(spark, span, size)


def plan_stream_slices(spark: SparkSession, span: Range, events_per_slice: int = 0) -> DataFrame:
    """The same over sequences.

    The limit counts one event more than the range has, so that exactly
    ``MAX_SLICES`` full slices are refused.
    """
    size = _size(events_per_slice, EVENTS_PER_SLICE)
    count = -(-(span.end - span.start + 1) // size)
    if count > MAX_SLICES:
        raise InvalidArgument(f"{count} slices of {size} events are more than {MAX_SLICES}")
    return _slices(spark, span, size)


def batch_plans(span: Range, blocks_per_slice: int = 0) -> list[Range]:
    """The range as stretches that :func:`plan_batch_slices` takes one by one.

    One stretch if the range is within the limit of a plan. Stretches end at slices' ends,
    so the plans together have the slices that one plan of the whole range would have.
    """
    return _plans(span, _size(blocks_per_slice, BLOCKS_PER_SLICE) * MAX_SLICES)


def stream_plans(span: Range, events_per_slice: int = 0) -> list[Range]:
    """The same for :func:`plan_stream_slices`, whose limit counts one event more."""
    size = _size(events_per_slice, EVENTS_PER_SLICE)
    fits = span.end - span.start < size * MAX_SLICES
    return [span] if fits else _plans(span, size * (MAX_SLICES - 1))


def _plans(span: Range, most: int) -> list[Range]:
    return [Range(at, min(at + most, span.end)) for at in range(span.start, span.end, most)]


def missing_heights(
    blocks: DataFrame | BlockStore,
    start: int,
    end: int,
    *,
    family: str = "evm",
    height: str | None = None,
) -> DataFrame:
    """Heights of ``[start, end)`` without a block, as ``height``.

    Heights are made distinct before they are joined, so that a height with very
    many rows is folded where it is read.
    """
    number = F.col(height or HEIGHT[family])
    store = BlockStore.of(blocks)
    present = (
        store.within(start, end)
        .where((number >= start) & (number < end))
        .select(number.cast("bigint").alias("__height"))
        .distinct()
    )
    wanted = store.frame.sparkSession.range(start, end).withColumnRenamed("id", "height")
    return wanted.join(present, F.col("height") == F.col("__height"), "left_anti")


def _folded(
    blocks: DataFrame | BlockStore, start: int, end: int, number: Column
) -> DataFrame:
    """The heights of ``[start, end)``, folded into a bitmap for each ``BITMAP`` of them.

    Rows are folded where they are read, so one shuffle moves a bitmap for each task and
    stretch, however often a height is stored.
    """
    place = number.cast("bigint") + 1  # the bitmap functions count from 1
    return (
        BlockStore.of(blocks)
        .within(start, end)
        .where((number >= start) & (number < end))
        .groupBy((F.bitmap_bucket_number(place) - 1).alias("stretch"))
        .agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("heights"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def height_gaps(
    blocks: DataFrame | BlockStore,
    start: int,
    end: int,
    *,
    family: str = "evm",
    height: str | None = None,
) -> DataFrame:
    """Stretches of ``[start, end)`` without any block, as (gap_start, gap_end), half-open
    and as long as possible.

    Heights are folded to bitmaps; only stretches whose bitmap has holes are looked at
    again. Inside a stretch gaps lie between neighbouring heights. Gaps at the edges of
    stretches, and whole empty stretches, are put together over all stretches: these
    are a few rows for every ``BITMAP`` heights.
    """
    number = F.col(height or HEIGHT[family])
    spark = BlockStore.of(blocks).frame.sparkSession
    if end <= start:
        return spark.createDataFrame([], "gap_start BIGINT, gap_end BIGINT")
    low = F.greatest(F.col("stretch") * BITMAP, F.lit(start))
    high = F.least((F.col("stretch") + 1) * BITMAP, F.lit(end))
    stretches = spark.range(start // BITMAP, (end - 1) // BITMAP + 1).withColumnRenamed("id", "stretch")
    folded = _folded(blocks, start, end, number)
    holes = (
        stretches.join(folded, "stretch", "left")
        .select("stretch", low.alias("low"), high.alias("high"), F.coalesce("heights", F.lit(0)).alias("heights"))
        .where("heights < high - low")
    )
    stretch = F.floor(number.cast("bigint") / BITMAP)
    there = (
        BlockStore.of(blocks)
        .within(start, end)
        .where((number >= start) & (number < end))
        .select(stretch.alias("stretch"), number.cast("bigint").alias("there"))
        .join(holes.where("heights > 0").select("stretch"), "stretch", "left_semi")
        .groupBy("stretch")
        .agg(F.array_sort(F.collect_set("there")).alias("there"))
    )
    # A set has at most BITMAP heights; a gap lies between two neighbours, or an edge and one.
    inside = F.coalesce("there", F.array().cast("array<bigint>"))
    before, after = F.concat(F.array(F.col("low") - 1), inside), F.concat(inside, F.array("high"))
    between = F.zip_with(
        before, after, lambda a, b: F.struct((a + 1).alias("gap_start"), b.alias("gap_end"))
    )
    gaps = (
        holes.join(there, "stretch", "left")
        .select("low", "high", F.explode(F.filter(between, lambda g: g["gap_end"] > g["gap_start"])).alias("gap"))
        .select("low", "high", "gap.*")
    )
    edge = (F.col("gap_start") == F.col("low")) | (F.col("gap_end") == F.col("high"))
    inner = gaps.where(~edge).select("gap_start", "gap_end")
    joined = (
        gaps.where(edge)
        .selectExpr("gap_start", "gap_end", "lag(gap_end) OVER (ORDER BY gap_start) <=> gap_start AS goes_on")
        .selectExpr("*", "sum(if(goes_on, 0, 1)) OVER (ORDER BY gap_start) AS island")
        .groupBy("island")
        .agg(F.min("gap_start").alias("gap_start"), F.max("gap_end").alias("gap_end"))
    )
    return inner.union(joined.select("gap_start", "gap_end"))


def doubled_heights(
    blocks: DataFrame | BlockStore,
    start: int,
    end: int,
    *,
    family: str = "evm",
    height: str | None = None,
) -> DataFrame:
    """Heights of ``[start, end)`` that are stored more than once, as (height, blocks)."""
    number = F.col(height or HEIGHT[family])
    return (
        BlockStore.of(blocks)
        .within(start, end)
        .where((number >= start) & (number < end))
        .groupBy(number.cast("bigint").alias("height"))
        .agg(F.count(F.lit(1)).alias("blocks"))
        .where("blocks > 1")
    )


def require_complete(
    blocks: DataFrame | BlockStore, start: int, end: int, *, family: str = "evm", height: str | None = None
) -> None:
    """Refuse a range with gaps, with heights stored more than once (a block written
    twice, a fork, or the same block under two tags), or with blocks that have lost
    their header.

    Runs over the heights alone, in one pass. A block without header has no height, so
    it could lie in any range: it is refused in every one that reads its directory.
    """
    number = F.col(height or HEIGHT[family])
    store = BlockStore.of(blocks)
    inside = (number >= start) & (number < end)
    place = number.cast("bigint") + 1
    # Blocks without a height have a row of their own.
    found, rows, lost = (
        store.within(start, end)
        .where(inside | number.isNull())
        .groupBy(F.bitmap_bucket_number(place).alias("stretch"))
        .agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("heights"),
            F.count(number).alias("rows"),
            F.count(F.when(number.isNull(), 1)).alias("lost"),
        )
        .agg(*(F.coalesce(F.sum(name), F.lit(0)) for name in ("heights", "rows", "lost")))
        .first()
    )
    if lost:
        raise InvalidArgument(f"{lost} blocks have no height: their header is missing")
    if rows > found:
        doubled = doubled_heights(blocks, start, end, family=family, height=height)
        first, count = doubled.agg(F.min_by(F.struct("height", "blocks"), "height"), F.count(F.lit(1))).first()
        raise InvalidArgument(
            f"{count} heights are stored more than once in [{start}, {end}), "
            f"first {first['height']}, {first['blocks']} times"
        )
    if found == end - start:
        return
    gaps = height_gaps(blocks, start, end, family=family, height=height)
    missing, first, last = gaps.agg(
        F.sum(F.col("gap_end") - F.col("gap_start")), F.min("gap_start"), F.min_by("gap_end", "gap_start")
    ).first()
    raise NotFound(f"{missing} blocks are missing in [{start}, {end}), first {first} to {last - 1}")
