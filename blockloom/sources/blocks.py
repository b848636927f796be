"""Reading parsed blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.errors import InvalidArgument
from blockloom.schemas.inputs import HASH, HEIGHT, block_schema

BLOCK_HEIGHT, BLOCK_HASH, HEIGHT_BUCKET = "block_height", "block_hash", "height_bucket"
# Sizes of a bucketed store: a bucket is read by one task, and is a file in each directory.
BLOCKS_PER_BUCKET, LEAST_BUCKETS, MOST_DIRECTORIES = 100_000, 8, 32


@dataclass(frozen=True)
class BlockStore:
    """Blocks and, where they lie in a directory per bucket of heights, that layout.

    ``bucket_column`` is the height rounded down to ``bucket_size``. ``height`` and
    ``block_hash`` name columns of their own for these, where a store has them; one that
    :func:`write_block_store` has written is bucketed by them and the tag, and its blocks
    are joined where they lie.
    """

    frame: DataFrame
    bucket_column: str | None = None
    bucket_size: int = 0
    height: str | None = None
    block_hash: str | None = None

    def __post_init__(self) -> None:
        if (self.bucket_column is None) != (self.bucket_size <= 0):
            raise InvalidArgument("name the bucket column and its size, or neither")

    @staticmethod
    def of(blocks: DataFrame | BlockStore) -> BlockStore:
        return blocks if isinstance(blocks, BlockStore) else BlockStore(blocks)

    def within(self, start: int, end: int) -> DataFrame:
        """The directories that may hold heights of ``[start, end)``."""
        if self.bucket_column is None:
            return self.frame
        return prune_partitions(self.frame, self.bucket_column, self.bucket_size, start, end)

    def in_buckets(self, buckets: list[int]) -> DataFrame:
        """The named directories alone."""
        if self.bucket_column is None:
            return self.frame
        return self.frame.where(F.col(self.bucket_column).isin(buckets))

    def top(self) -> DataFrame:
        """The directory of the greatest heights; found from directory names."""
        if self.bucket_column is None:
            return self.frame
        last = self.frame.agg(F.max(self.bucket_column)).first()[0]
        return self.frame.where(F.col(self.bucket_column) == F.lit(last))


@dataclass(frozen=True)
class SplitStore:
    """Blocks in two tables, for chains with very uneven blocks.

    ``transactions`` has (tag, height, hash, transaction), ``headers`` (tag, height, hash,
    header): a block of any size is many rows. ``blocks`` are the blocks as nested rows,
    for the tables that list what a block holds; without them there are none. A bucket
    column, if given, is one of both tables.
    """

    transactions: DataFrame
    headers: DataFrame
    blocks: DataFrame | BlockStore | None = None
    bucket_column: str | None = None
    bucket_size: int = 0

    def heights(self) -> BlockStore:
        """The headers, which tell what blocks there are."""
        return BlockStore(self.headers, self.bucket_column, self.bucket_size, "height", "hash")

    def rows(self) -> BlockStore:
        return BlockStore(self.transactions, self.bucket_column, self.bucket_size, "height", "hash")


def store_sizes(
    blocks: DataFrame, bucket_size: int, *, family: str = "evm", height: str | None = None
) -> tuple[int, int]:
    """The ``bucket_size`` and ``buckets`` to store blocks with, by how many there are.

    Buckets grow in number with the blocks, so that what one task reads does not;
    directories, a multiple of the given ``bucket_size`` each, don't: every one has a file
    a bucket.
    """
    number = F.col(height or HEIGHT[family])
    low, high, count = blocks.agg(F.min(number), F.max(number), F.count(F.lit(1))).first()
    if low is None:
        return bucket_size, LEAST_BUCKETS
    wide = -(-(int(high) - int(low) + 1) // (bucket_size * MOST_DIRECTORIES))
    return bucket_size * wide, max(LEAST_BUCKETS, -(-count // BLOCKS_PER_BUCKET))


def write_block_store(
    blocks: DataFrame,
    table: str,
    path: str,
    *,
    family: str = "evm",
    bucket_size: int,
    buckets: int,
    compression: str = "zstd",
) -> None:
    """Add blocks to a table at ``path`` that joins need not shuffle.

    It has a directory for each ``bucket_size`` heights and, in each, ``buckets`` buckets
    by (tag, height, hash). Blocks are shuffled here, once, to the task that owns their
    bucket; each writes one file a directory.
    """
    if bucket_size <= 0 or buckets <= 0:
        raise InvalidArgument(f"a store needs sizes: {bucket_size} heights, {buckets} buckets")
    number = F.col(HEIGHT[family])
    keyed = blocks.select(
        *block_schema(family).fieldNames(),
        number.alias(BLOCK_HEIGHT),
        F.col(HASH[family]).alias(BLOCK_HASH),
        (number - number % bucket_size).alias(HEIGHT_BUCKET),
    )
    keys = ("tag", BLOCK_HEIGHT, BLOCK_HASH)
    (
        keyed.repartition(buckets, *keys)
        .sortWithinPartitions(HEIGHT_BUCKET, *keys)
        .write.mode("append")
        .format("parquet")
        .option("path", path)
        .option("compression", compression)
        .partitionBy(HEIGHT_BUCKET)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def read_block_store(spark: SparkSession, table: str, bucket_size: int) -> BlockStore:
    """A store that :func:`write_block_store` has written, by the name of its table."""
    return BlockStore(spark.table(table), HEIGHT_BUCKET, bucket_size, BLOCK_HEIGHT, BLOCK_HASH)


def read_blocks(
    spark: SparkSession,
    path: str,
    family: str = "evm",
    format: str = "parquet",
    u64: str = "long",
    bucket_column: str | None = None,
) -> DataFrame:
    """Blocks as nested rows, one per block. The schema is given, never inferred.

    ``u64="decimal"`` reads unsigned 64-bit values past 2^63-1, as Parquet's UINT_64.
    A store with a directory per height bucket names that column.
    """
    schema = block_schema(family, u64)
    if bucket_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(bucket_column, T.LongType())])
    reader = spark.read.schema(schema)
    if format == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(format).load(path)


def parse_blocks(
    texts: DataFrame, column: str = "value", family: str = "evm", u64: str = "long"
) -> DataFrame:
    """Blocks from JSON text, one block per row; malformed text fails the job."""
    parsed = F.from_json(F.col(column), block_schema(family, u64), {"mode": "FAILFAST"})
    return texts.select(parsed.alias("block")).select("block.*")


def prune_partitions(
    df: DataFrame, column: str, size: int, start: int, end: int
) -> DataFrame:
    """Only directories that may hold ``[start, end)``, where ``column`` is the value
    rounded down to ``size``. Spark cannot derive this from a filter on the value."""
    if size <= 0:
        return df
    return df.where(F.col(column).between(start - start % size, (end - 1) - (end - 1) % size))


def scan_blocks(
    blocks: DataFrame | BlockStore,
    start: int,
    end: int,
    *,
    family: str = "evm",
    height: str | None = None,
    bucket_column: str | None = None,
    bucket_size: int = 0,
) -> DataFrame:
    """Blocks with a height in ``[start, end)``; the range is taken strictly as given.

    The filter reaches the Parquet scan. Where the store has a directory per
    height bucket, name its column and size, or give a ``BlockStore``, to skip
    whole directories.
    """
    if start < 0 or end <= start:
        raise InvalidArgument(f"heights must satisfy 0 <= start < end: {start}, {end}")
    if bucket_column is not None:
        blocks = BlockStore(blocks, bucket_column, bucket_size)
    number = F.col(height or HEIGHT[family])
    return BlockStore.of(blocks).within(start, end).where((number >= start) & (number < end))
