"""Partitioned Parquet by the two layout columns that every table carries.

Rows with one ``_partition_by`` share a directory; within their files they are sorted
by ``_repartition_by_range``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.errors import InvalidArgument
from blockloom.schemas.tables import PARTITION_BY, PARTITION_SIZE, RANGE_BY, SEQUENCE_NUMBER
from blockloom.sinks.files import create, names, read
from blockloom.sources.blocks import prune_partitions

# What tells rows of one height or sequence apart: the first that a table has.
_INDEXES = ("transaction_index", "index")
_TIE_BREAKERS = (*_INDEXES, "transaction_hash", "hash")
ROWS_PER_FILE = 5_000_000
# Rows of one block that are dealt out together.
PIECE = 10_000
# Tasks that a directory is dealt out to where no column tells its rows apart.
SPREAD = 16
_PIECE = "__piece"
SIZE_NOTE = "_partition_by_size"


def tie_breakers(df: DataFrame) -> list[str | Column]:
    """What tells rows of one height or sequence apart; without such a column, a hash
    of the whole row."""
    present = [name for name in _TIE_BREAKERS if name in df.columns]
    return list(present[:1]) or [F.xxhash64(*df.columns)]


def partition_size(df: DataFrame) -> int:
    """The partition size that a table was built with; 0 if it isn't known."""
    return df.schema[PARTITION_BY].metadata.get(PARTITION_SIZE, 0)


def arrange(
    df: DataFrame, partitions: int | None = None, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Deal the rows out and sort them for the sink.

    A table with a partition size is dealt out by directory, and a block of very many
    rows by pieces of ``PIECE`` of them as well. Nothing has to be sampled, so what makes
    the rows runs once, and a directory has one file for most blocks; adaptive execution
    puts small tasks together and cuts up those of large directories. Other tables, and
    those with a wanted number of partitions, are partitioned by range, for which Spark
    samples the rows first. Without a number Spark uses the session's and merges small
    partitions at run time.
    """
    keys = [RANGE_BY, *(tie_breakers(df) if order is None else order)]
    if partitions is None and partition_size(df) > 0:
        pieces = df.withColumn(_PIECE, _piece(df))
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            dealt = pieces.hint("rebalance", PARTITION_BY, _PIECE)
        else:
            dealt = pieces.repartition(PARTITION_BY, _PIECE)
        dealt = dealt.drop(_PIECE)
    elif partitions is None:
        dealt = df.repartitionByRange(*keys)
    else:
        dealt = df.repartitionByRange(partitions, *keys)
    return dealt.sortWithinPartitions(PARTITION_BY, *keys)


def _piece(df: DataFrame) -> Column:
    """Which piece of its block a row is in; without an index, a part by hash of those
    rows that nothing tells apart."""
    for name in _INDEXES:
        if name in df.columns:
            return F.floor(F.col(name) / PIECE).cast("bigint")
    if any(name in df.columns for name in _TIE_BREAKERS):
        return F.lit(0).cast("bigint")
    return F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))


def read_note(spark: SparkSession, path: str, name: str) -> str | None:
    """The text that a table's folder keeps under a name hidden from scans."""
    return read(spark, f"{path.rstrip('/')}/{name}")


def note(spark: SparkSession, path: str, name: str, wanted: str) -> str:
    """Keep ``wanted`` under a name if nothing is kept there yet; what is kept.

    A note is created, never overwritten, and read back: of two writers that come at
    once both get what one of them has kept.
    """
    kept = read_note(spark, path, name)
    if kept is None and not create(spark, f"{path.rstrip('/')}/{name}", wanted):
        kept = read_note(spark, path, name)
    return wanted if kept is None else kept


def keep_size(spark: SparkSession, path: str, size: int) -> None:
    """Store a table's partition size with it; refuse one that disagrees."""
    kept = int(note(spark, path, SIZE_NOTE, str(size)))
    if kept != size:
        raise InvalidArgument(f"{path} is partitioned by {kept}, not by {size}")


def write_table(
    df: DataFrame,
    path: str,
    *,
    partitions: int | None = None,
    mode: str = "errorifexists",
    compression: str = "zstd",
    rows_per_file: int = ROWS_PER_FILE,
    shuffle: bool = True,
) -> None:
    """Write a table by its layout columns, its partition size beside it.

    ``shuffle=False`` keeps the rows where they are, for blocks that already lie
    in height order; the rows are then only sorted within their tasks, so that a
    task holds one file open at a time. Rows are appended only to a table that is known
    to have the same partition size: the size is stored before any row, and data without
    a stored size is refused.
    """
    spark = df.sparkSession
    held = set(names(spark, path))
    rows = {name for name in held if not name.startswith((".", "_")) or name.startswith(f"{PARTITION_BY}=")}
    if mode == "append" and rows and SIZE_NOTE not in held:
        raise InvalidArgument(f"{path} has rows, but it isn't known how they are partitioned")
    if mode == "append" or (mode == "errorifexists" and not rows):
        keep_size(spark, path, partition_size(df))
        mode = "append"
    if shuffle:
        arranged = arrange(df, partitions)
    else:
        arranged = df.sortWithinPartitions(PARTITION_BY, RANGE_BY, *tie_breakers(df))
    (
        arranged.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(PARTITION_BY)
        .parquet(path)
    )
    keep_size(spark, path, partition_size(df))


def write_part(
    table: DataFrame,
    path: str,
    partitions: int | None = None,
    compression: str = "zstd",
    shuffle: bool = True,
) -> None:
    """Write a part of a table over whatever its directory holds; its caller keeps track
    of parts, and of the partition size."""
    order = event_order(table) if SEQUENCE_NUMBER in table.columns else [RANGE_BY, *tie_breakers(table)]
    if shuffle:
        arranged = arrange(table, partitions, order)
    else:
        arranged = table.sortWithinPartitions(PARTITION_BY, *order)
    (
        arranged.write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(PARTITION_BY)
        .parquet(path)
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    start: int | None = None,
    end: int | None = None,
    partition_by_size: int | None = None,
) -> DataFrame:
    """A written table, optionally only ``[start, end)`` of heights or sequences.

    Directories outside the range are not even listed into the scan, by the partition
    size that is stored with the table. A size that disagrees with it is refused; a
    table without a stored one is read by the rows' own position alone.
    """
    kept = read_note(spark, path, SIZE_NOTE)
    if kept is not None and partition_by_size not in (None, int(kept)):
        raise InvalidArgument(f"{path} is partitioned by {kept}, not by {partition_by_size}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if start is None and end is None:
        return df
    if start is None or end is None or end <= start or start < 0:
        raise InvalidArgument(f"range must satisfy 0 <= start < end: {start}, {end}")
    position: Column = F.col(RANGE_BY)
    in_range = df.where((position >= start) & (position < end))
    return prune_partitions(in_range, PARTITION_BY, int(kept or 0), start, end)


def event_order(df: DataFrame) -> list[str | Column]:
    """Columns that put streamed rows into the order of the event log."""
    return [SEQUENCE_NUMBER, *tie_breakers(df)]
