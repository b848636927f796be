"""Reading the chain's event log, as a batch or a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.errors import InvalidArgument, NotFound
from blockloom.functions.scalars import partition_floor
from blockloom.schemas.inputs import EVENTS
from blockloom.sinks.files import names
from blockloom.sinks.layout import note, read_note
from blockloom.sources.blocks import prune_partitions

SEQUENCE_BUCKET = "sequence_bucket"
BUCKET_NOTE = "_sequence_bucket_size"
EVENTS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class EventStore:
    """An event log that lies in a directory for each ``bucket_size`` sequences.

    Ranges read only their directories. The first and last sequence come from the
    directories' names and then from the statistics in the footers of the files in two
    of them: no event is read for it.
    """

    spark: SparkSession
    path: str
    bucket_size: int
    frame: DataFrame = field(compare=False)

    def within(self, start: int, end: int) -> DataFrame:
        """Events of ``[start, end)``, from the directories that may hold them."""
        sequence = F.col("sequence_num")
        inside = self.frame.where((sequence >= start) & (sequence < end))
        pruned = prune_partitions(inside, SEQUENCE_BUCKET, self.bucket_size, start, end)
        return pruned.select(*EVENTS.fieldNames())

    def buckets(self) -> list[int]:
        """The directories that there are, ascending."""
        held = (name.partition("=") for name in names(self.spark, self.path))
        return sorted(int(value) for key, _, value in held if key == SEQUENCE_BUCKET and value.lstrip("-").isdigit())

    def bounds(self) -> tuple[int, int]:
        """First and last sequence."""
        buckets = self.buckets()
        return self._found(self._extreme(buckets, 0)), self._found(self._extreme(buckets[::-1], 1))

    def first(self) -> int:
        return self._found(self._extreme(self.buckets(), 0))

    def last(self) -> int:
        return self._found(self._extreme(self.buckets()[::-1], 1))

    @staticmethod
    def _found(sequence: int | None) -> int:
        if sequence is None:
            raise NotFound("there are no events")
        return sequence

    def extremes(self, bucket: int) -> DataFrame:
        """Least and greatest sequence of a directory, one row; from the footers if the
        session lets Spark push aggregates down, see :func:`footer_statistics`."""
        schema = T.StructType([EVENTS["sequence_num"]])
        part = self.spark.read.schema(schema).parquet(f"{self.path}/{SEQUENCE_BUCKET}={bucket}")
        return part.agg(F.min("sequence_num").alias("low"), F.max("sequence_num").alias("high"))

    def _extreme(self, buckets: list[int], which: int) -> int | None:
        for bucket in buckets:  # a directory may be empty
            with footer_statistics(self.spark):
                found = self.extremes(bucket).first()[which]
            if found is not None:
                return found
        return None


@contextmanager
def footer_statistics(spark: SparkSession) -> Iterator[None]:
    """While it lasts, minima, maxima and counts of whole Parquet files come from their footers."""
    wanted = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
    kept = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_event_store(events: DataFrame, path: str, bucket_size: int, *, compression: str = "zstd") -> None:
    """Add events to a store, in a directory for each ``bucket_size`` sequences, sorted.

    The size is stored before any event; another one is refused. Rows are dealt out by
    directory and a hash, so a large directory is written by several tasks.
    """
    if bucket_size <= 0:
        raise InvalidArgument(f"directories must hold events: {bucket_size}")
    spark, path = events.sparkSession, path.rstrip("/")
    kept = int(note(spark, path, BUCKET_NOTE, str(bucket_size)))
    if kept != bucket_size:
        raise InvalidArgument(f"{path} has {kept} sequences a directory, not {bucket_size}")
    bucket = partition_floor(F.col("sequence_num"), bucket_size)
    keyed = events.select(*EVENTS.fieldNames(), bucket.alias(SEQUENCE_BUCKET))
    (
        keyed.repartition(F.col(SEQUENCE_BUCKET), F.floor((F.col("sequence_num") % bucket_size) / EVENTS_PER_FILE))
        .sortWithinPartitions(SEQUENCE_BUCKET, "sequence_num")
        .write.mode("append")
        .option("compression", compression)
        .option("maxRecordsPerFile", EVENTS_PER_FILE)
        .partitionBy(SEQUENCE_BUCKET)
        .parquet(path)
    )


def read_event_store(spark: SparkSession, path: str) -> EventStore:
    """A store that :func:`write_event_store` has written."""
    path = path.rstrip("/")
    kept = read_note(spark, path, BUCKET_NOTE)
    if kept is None:
        raise NotFound(f"{path} is no event store")
    schema = T.StructType([*EVENTS.fields, T.StructField(SEQUENCE_BUCKET, T.LongType())])
    return EventStore(spark, path, int(kept), spark.read.schema(schema).parquet(path))


def read_events(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.schema(EVENTS).format(format).load(path)


def scan_events(events: DataFrame | EventStore, start: int, end: int) -> DataFrame:
    """Events with a sequence in ``[start, end)``; the range is taken strictly as given."""
    if end <= start:
        raise InvalidArgument(f"start sequence must be less than end sequence: {start}, {end}")
    if isinstance(events, EventStore):
        return events.within(start, end)
    sequence = F.col("sequence_num")
    return events.where((sequence >= start) & (sequence < end))


def stream_events(
    spark: SparkSession,
    path: str,
    *,
    start: int | None = None,
    format: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """The event log as a stream. ``path`` is a directory or a glob of files.

    ``start`` is the first sequence wanted; ``max_files`` or ``max_bytes`` bound
    a micro-batch.
    """
    reader = spark.readStream.schema(EVENTS).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    events = reader.load(path)
    return events if start is None else events.where(F.col("sequence_num") >= start)
