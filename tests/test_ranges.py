from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blockloom import ChainMetadata, InvalidArgument, NotFound
from blockloom.plans import ranges
from blockloom.plans.ranges import Range
from blockloom.sources.blocks import scan_blocks
from blockloom.sources.events import scan_events
from blockloom.sources.metadata import read_metadata

META = ChainMetadata(block_start_height=100, irreversible_distance=100)


def heights(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "height BIGINT")


def log(spark, first, last):
    return spark.range(first, last + 1).withColumnRenamed("id", "sequence_num")


def test_tip(spark):
    assert ranges.tip(heights(spark, 3, 120), META, height="height") == 20
    assert ranges.tip(heights(spark, 100), META, height="height") == 0
    with pytest.raises(InvalidArgument):
        ranges.tip(heights(spark, 99), META, height="height")
    with pytest.raises(NotFound):
        ranges.tip(heights(spark), META, height="height")


def test_earliest_is_configured(spark):
    assert ranges.earliest(META) == 100
    row = [(100, 50)]
    table = spark.createDataFrame(row, "block_start_height BIGINT, irreversible_distance BIGINT")
    assert read_metadata(table) == ChainMetadata(100, 50)
    with pytest.raises(NotFound):
        read_metadata(table.limit(0))


def test_event_positions(spark):
    events = log(spark, 100, 130)
    assert ranges.stream_earliest(events) == 100
    assert ranges.stream_tip(events) == 130
    with pytest.raises(InvalidArgument):
        ranges.event_position(events, "MIDDLE")
    with pytest.raises(NotFound):
        ranges.stream_tip(events.limit(0))


@pytest.mark.parametrize(
    "start, end, expected",
    [
        (150, 160, Range(150, 160)),
        (0, 160, Range(100, 160)),
        (150, 0, Range(150, 900)),
        (150, 5000, Range(150, 5000)),
    ],
)
def test_batch_range(spark, start, end, expected):
    blocks = heights(spark, 1000)
    assert ranges.resolve_batch_range(blocks, META, start, end, height="height") == expected


@pytest.mark.parametrize("start, end", [(150, 150), (150, 120), (0, 100), (950, 0), (-1, 5), (0, -1)])
def test_batch_range_refused(spark, start, end):
    with pytest.raises(InvalidArgument):
        ranges.resolve_batch_range(heights(spark, 1000), META, start, end, height="height")


@pytest.mark.parametrize(
    "start, end, size, first, last, expected",
    [
        (1, 2, 0, 0, 10, [(1, 2)]),
        (0, 3, 0, 1, 10, [(1, 3)]),
        (1, 12, 0, 0, 10, [(1, 11)]),
        (1, 11, 2, 0, 10, [(1, 3), (3, 5), (5, 7), (7, 9), (9, 11)]),
        (0, 9, 2, 0, 10, [(0, 2), (2, 4), (4, 6), (6, 8), (8, 9)]),
        (1, 0, 0, 0, 10, [(1, 11)]),
        (-5, 0, 0, 0, 10, [(0, 11)]),
    ],
)
def test_stream_slices(spark, start, end, size, first, last, expected):
    span = ranges.resolve_stream_range(log(spark, first, last), start, end)
    slices = ranges.plan_stream_slices(spark, span, size)
    assert sorted(map(tuple, slices.collect())) == expected


@pytest.mark.parametrize("start, end", [(11, 12), (2, 2), (5, 3), (0, -1)])
def test_stream_range_refused(spark, start, end):
    with pytest.raises(InvalidArgument):
        ranges.resolve_stream_range(log(spark, 0, 10), start, end)


def test_end_is_compared_after_clamping(spark):
    with pytest.raises(InvalidArgument):
        ranges.resolve_stream_range(log(spark, 5, 10), 0, 5)


def test_batch_slices(spark):
    slices = ranges.plan_batch_slices(spark, Range(100, 350))
    assert sorted(map(tuple, slices.collect())) == [(100, 200), (200, 300), (300, 350)]


def test_slice_limits(spark):
    limit = ranges.MAX_SLICES
    assert ranges.plan_batch_slices(spark, Range(0, limit * 2), 2).count() == limit
    with pytest.raises(InvalidArgument):
        ranges.plan_batch_slices(spark, Range(0, limit * 2 + 1), 2)
    # One event more is counted for streams.
    assert ranges.plan_stream_slices(spark, Range(0, limit * 2 - 1), 2).count() == limit
    with pytest.raises(InvalidArgument):
        ranges.plan_stream_slices(spark, Range(0, limit * 2), 2)
    with pytest.raises(InvalidArgument):
        ranges.plan_batch_slices(spark, Range(0, 10), -1)


@pytest.mark.parametrize("more", [-1, 0, 1, 2, 7])
def test_long_ranges_take_several_plans(spark, more):
    """The slices are those of one plan without a limit."""
    limit = ranges.MAX_SLICES
    span = Range(5, 5 + 4 * limit + more)
    expected = [(at, min(at + 2, span.end)) for at in range(span.start, span.end, 2)]
    for stretches, plan in (
        (ranges.batch_plans(span, 2), ranges.plan_batch_slices),
        (ranges.stream_plans(span, 2), ranges.plan_stream_slices),
    ):
        parts = [plan(spark, part, 2) for part in stretches]
        assert sorted(tuple(r) for part in parts for r in part.collect()) == expected
    short = Range(3, 3 + 2 * limit - 1)
    assert ranges.batch_plans(short, 2) == ranges.stream_plans(short, 2) == [short]


def test_scans_are_half_open_and_strict(spark):
    rows = scan_blocks(heights(spark, *range(10)), 3, 6, height="height").collect()
    assert sorted(r[0] for r in rows) == [3, 4, 5]
    assert scan_events(log(spark, 0, 10), 1, 6).count() == 5
    for start, end in [(2, 1), (2, 2)]:
        with pytest.raises(InvalidArgument):
            scan_blocks(heights(spark, 1), start, end, height="height")
        with pytest.raises(InvalidArgument):
            scan_events(log(spark, 0, 1), start, end)


def test_missing_heights(spark):
    blocks = heights(spark, 0, 1, 1, 4, 9)
    gaps = ranges.missing_heights(blocks, 0, 6, height="height")
    assert sorted(r[0] for r in gaps.collect()) == [2, 3, 5]
    once = heights(spark, 0, 1, 4, 9)
    ranges.require_complete(once, 0, 2, height="height")
    with pytest.raises(NotFound, match="3 blocks are missing.*first 2 to 3"):
        ranges.require_complete(once, 0, 6, height="height")


def test_heights_stored_twice_are_refused(spark):
    blocks = heights(spark, 0, 1, 1, 2, 3, 3, 3, 9)
    ranges.require_complete(blocks, 2, 3, height="height")
    with pytest.raises(InvalidArgument, match="2 heights are stored more than once.*first 1, 2 times"):
        ranges.require_complete(blocks, 0, 4, height="height")
    found = ranges.doubled_heights(blocks, 0, 10, height="height")
    assert sorted(map(tuple, found.collect())) == [(1, 2), (3, 3)]


def gaps_of(there, start, end):
    found, at = [], start
    for n in [*sorted(n for n in set(there) if start <= n < end), end]:
        if n > at:
            found.append((at, n))
        at = n + 1
    return found


@pytest.mark.parametrize(
    "start, end, gone",
    [
        (0, 10, []),
        (0, 10, [0, 9]),
        (5, 90_000, [*range(32_760, 32_780), *range(40_000, 80_000), 89_999, 7]),
        (100, 33_000, range(100, 33_000)),
        (32_768, 65_536, [32_768, 65_535]),
        (10, 200_000, [*range(11, 199_000)]),
    ],
)
def test_gaps_are_whole_intervals(spark, start, end, gone):
    gone = set(gone)
    rows = spark.range(start - 1, end + 2).where(~F.col("id").isin(sorted(gone))) if len(gone) < 50 else None
    if rows is None:
        rows = spark.createDataFrame([(n,) for n in gone], "n BIGINT").join(
            spark.range(start - 1, end + 2), F.col("n") == F.col("id"), "right"
        ).where("n IS NULL").select("id")
    rows = rows.withColumnRenamed("id", "height")
    found = ranges.height_gaps(rows, start, end, height="height")
    want = gaps_of([n for n in range(start - 1, end + 2) if n not in gone], start, end)
    assert sorted(map(tuple, found.collect())) == want


def test_completeness_needs_one_shuffle_of_folded_heights(spark):
    frame = spark.range(0, 100_000, 1, 8).withColumnRenamed("id", "height")
    folded = ranges._folded(frame, 0, 100_000, F.col("height"))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan
