"""One chain's stores behind the batch and stream queries that users write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from blockloom.builders import block_family, build, build_split, is_added, is_split
from blockloom.errors import InvalidArgument, NotFound
from blockloom.metrics import count_blocks
from blockloom.plans import ranges
from blockloom.plans.catalog import list_tables
from blockloom.schemas.tables import NATIVE, NONE, TableKey, family_of, table_schema, tables_of
from blockloom.sinks.layout import keep_size, write_part
from blockloom.sinks.slices import Progress, keep_slices, write_slices
from blockloom.sources.blocks import BlockStore, SplitStore, scan_blocks
from blockloom.sources.events import EventStore, scan_events
from blockloom.sources.metadata import ChainMetadata
from blockloom.streaming.streams import EVENTS_PER_BACKFILL, backfill, streamed_table

# Heights of a backfill's slice where a query names no number.
BLOCKS_PER_BACKFILL = 10_000


@dataclass(frozen=True)
class BatchQuery:
    """Heights ``[start_height, end_height)``; end 0 is the tip."""

    table: str
    start_height: int = 0
    end_height: int = 0
    format: str = NATIVE
    encoding: str = NONE
    partition_by_size: int = 0
    blocks_per_partition: int = 0

    @property
    def key(self) -> TableKey:
        return TableKey(self.table, self.format, self.encoding)


@dataclass(frozen=True)
class StreamQuery:
    """Sequences ``[start_sequence, end_sequence)``; end 0 is the whole rest."""

    table: str
    start_sequence: int = 0
    end_sequence: int = 0
    format: str = NATIVE
    encoding: str = NONE
    partition_by_size: int = 0
    events_per_partition: int = 0

    @property
    def key(self) -> TableKey:
        return TableKey(self.table, self.format, self.encoding)


@dataclass(frozen=True)
class Ledger:
    """``blocks`` maps a family (evm, bitcoin, rosetta) to its parsed blocks.

    A store with a directory per bucket of heights is given as a ``BlockStore``, an event
    log with one per bucket of sequences as an ``EventStore``; every query then reads
    only the directories that it needs. Blocks whose transactions lie in a table of their
    own are a ``SplitStore``. Positions are those of the chain's native blocks or, where
    there are none, of the only other family.
    """

    chain: str
    network: str
    blocks: Mapping[str, DataFrame | BlockStore | SplitStore]
    events: DataFrame | EventStore | None = None
    metadata: ChainMetadata = field(default_factory=ChainMetadata)
    u64: str = "long"

    def tables(self) -> list[TableKey]:
        return tables_of(self.chain, self.network)

    def list_tables(self) -> DataFrame:
        return list_tables(self._session(), self.chain, self.network, u64=self.u64)

    def schema(self, table: str, format: str = NATIVE, encoding: str = NONE) -> T.StructType:
        return table_schema(self.chain, self._known(TableKey(table, format, encoding)), self.u64)

    def tip(self) -> int:
        store, family = self._native()
        return ranges.tip(store, self.metadata, family=family, height=store.height)

    def earliest(self) -> int:
        return ranges.earliest(self.metadata)

    def stream_tip(self) -> int:
        return ranges.stream_tip(self._log())

    def stream_earliest(self) -> int:
        return ranges.stream_earliest(self._log())

    def batch(
        self,
        query: BatchQuery,
        *,
        check: bool = True,
        seen: Observation | None = None,
        **options,
    ) -> DataFrame:
        """Resolve the range of the query and build its table.

        A range with missing blocks, blocks stored twice, or blocks that have lost their
        header, is refused before anything is returned; ``check=False`` takes what there
        is. ``seen`` counts the blocks that are processed, once for the table; those of a
        split store are counted by :meth:`backfill`. ``spread`` deals out the transactions
        of nested blocks in pieces of that many.
        """
        key = self._known(query.key)
        if key.streamed:
            raise InvalidArgument(f"not a batch table: {key}")
        span = self._batch_range(query)
        if check:
            self._require_complete(key, span)
        return self._table(key, span, query.partition_by_size, seen, options)

    def batch_slices(self, query: BatchQuery) -> DataFrame:
        self._known(query.key)
        return ranges.plan_batch_slices(
            self._session(), self._batch_range(query), query.blocks_per_partition
        )

    def stream(
        self, query: StreamQuery, *, seen: Observation | None = None, **options
    ) -> DataFrame:
        """Resolve the range of the query and build its table as a bounded replay.

        ``seen`` counts the events that are processed, once for the table.
        """
        key = self._known(query.key)
        log = self._log()
        span = ranges.resolve_stream_range(log, query.start_sequence, query.end_sequence)
        return streamed_table(
            self.chain,
            key,
            scan_events(log, span.start, span.end),
            self._source(key),
            partition_by_size=query.partition_by_size,
            u64=self.u64,
            seen=seen,
            **options,
        )

    def stream_slices(self, query: StreamQuery) -> DataFrame:
        self._known(query.key)
        span = ranges.resolve_stream_range(self._log(), query.start_sequence, query.end_sequence)
        return ranges.plan_stream_slices(self._session(), span, query.events_per_partition)

    def backfill(
        self,
        query: BatchQuery | StreamQuery,
        path: str,
        *,
        at_once: int = 4,
        check: bool = True,
        **options,
    ) -> Progress:
        """Write the table of a query slice by slice; a run that is repeated goes on.

        Slices of ``blocks_per_partition`` heights (or ``events_per_partition``
        sequences) begin at multiples of that number, but not before the chain, and are
        read and checked whole from there on. Each finished one is logged beside the
        table, with the blocks or events that it took: a run after a failure, or
        one whose range reaches further, writes what is missing and nothing else. Read
        the table with ``sinks.slices.read_slices``.
        """
        key, size = self._known(query.key), query.partition_by_size
        if isinstance(query, StreamQuery):
            return backfill(
                self.chain,
                key,
                self._log(),
                self._source(key),
                path,
                query.start_sequence,
                query.end_sequence,
                events_per_slice=query.events_per_partition or EVENTS_PER_BACKFILL,
                at_once=at_once,
                partition_by_size=size,
                u64=self.u64,
                **options,
            )
        if key.streamed:
            raise InvalidArgument(f"not a batch table: {key}")
        spark, blocks = self._session(), query.blocks_per_partition or BLOCKS_PER_BACKFILL
        span = self._batch_range(query)
        aligned = ranges.Range(span.start - span.start % blocks, span.end)
        planned = ranges.plan_batch_slices(spark, aligned, blocks)
        keep_slices(spark, path, blocks, f"{self.chain}:{key}")
        keep_size(spark, path, size)

        def write(begin: int, end: int, directory: str) -> int:
            part = ranges.Range(max(begin, self.metadata.block_start_height), end)
            if check:
                self._require_complete(key, part)
                took = part.end - part.start
            else:
                took = self._heights(key, part).count()
            write_part(self._table(key, part, size, None, options), directory)
            return took

        begins = (row["slice_start"] for row in planned.orderBy("slice_start").toLocalIterator())
        return write_slices(
            spark, path, begins, lambda begin: min(begin + blocks, span.end), write, at_once
        )

    def _table(
        self,
        key: TableKey,
        span: ranges.Range,
        partition_by_size: int,
        seen: Observation | None,
        options: dict,
    ) -> DataFrame:
        """A batch table over a range that has been resolved and checked."""
        family, source = block_family(self.chain, key), self._source(key)
        options = {"partition_by_size": partition_by_size, "u64": self.u64} | options
        if isinstance(source, SplitStore):
            if seen is not None:
                raise InvalidArgument("blocks of a split store are counted by a backfill")
            rows, headers = (
                scan_blocks(part, span.start, span.end, height="height")
                for part in (source.rows(), source.heights())
            )
            return build_split(self.chain, key, rows, headers, **options)
        blocks = scan_blocks(source, span.start, span.end, family=family, height=source.height)
        if seen is not None:
            blocks = count_blocks(blocks, seen)
        return build(self.chain, key, blocks, **options)

    def _heights(self, key: TableKey, span: ranges.Range) -> DataFrame:
        source = self._source(key)
        store = source.heights() if isinstance(source, SplitStore) else source
        family = block_family(self.chain, key)
        return scan_blocks(store, span.start, span.end, family=family, height=store.height)

    def _require_complete(self, key: TableKey, span: ranges.Range) -> None:
        source = self._source(key)
        store = source.heights() if isinstance(source, SplitStore) else source
        family = block_family(self.chain, key)
        ranges.require_complete(store, span.start, span.end, family=family, height=store.height)

    def _batch_range(self, query: BatchQuery) -> ranges.Range:
        store, family = self._native()
        return ranges.resolve_batch_range(
            store,
            self.metadata,
            query.start_height,
            query.end_height,
            family=family,
            height=store.height,
        )

    def _known(self, key: TableKey) -> TableKey:
        if key not in self.tables() and not is_added(self.chain, key):
            raise NotFound(f"no table {key} on {self.chain}-{self.network}")
        return key

    def _log(self) -> DataFrame | EventStore:
        if self.events is None:
            raise NotFound(f"{self.chain}-{self.network} has no event log")
        return self.events

    def _source(self, key: TableKey) -> BlockStore | SplitStore:
        """What a table is built from."""
        family = block_family(self.chain, key)
        if family not in self.blocks:
            raise NotFound(f"{self.chain}-{self.network} has no {family} blocks")
        found = self.blocks[family]
        if isinstance(found, SplitStore):
            if is_split(self.chain, key):
                return found
            if found.blocks is None:
                raise NotFound(f"{key} lists what blocks hold: the split store has no blocks")
            found = found.blocks
        return BlockStore.of(found)

    def _native(self) -> tuple[BlockStore, str]:
        """Blocks that positions are counted by, and their family."""
        family = family_of(self.chain)
        if family not in self.blocks:
            if len(self.blocks) != 1:
                raise NotFound(f"{self.chain}-{self.network} has no {family} blocks to count by")
            family = next(iter(self.blocks))
        found = self.blocks[family]
        return found.heights() if isinstance(found, SplitStore) else BlockStore.of(found), family

    def _session(self) -> SparkSession:
        return self._native()[0].frame.sparkSession
