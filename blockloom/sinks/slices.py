"""Tables written slice by slice, with a log of what is finished.

A slice begins at a multiple of the slice size and has a directory of its own. Once it is
written, an empty file beside the table says so: ``_commits/<begin>-<end>-<processed>``.
A run that is repeated, after a failure or because the chain has grown, writes only what
is not finished; a reader sees finished slices alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.errors import InvalidArgument
from blockloom.sinks import files
from blockloom.sinks.layout import note, read_table

SLICE, SLICE_NOTE, TABLE_NOTE, COMMITS = "slice", "_events_per_slice", "_table", "_commits"


@dataclass(frozen=True)
class Commit:
    """A finished slice: its positions ``[begin, end)``, and how many blocks or events it took."""

    begin: int
    end: int
    processed: int

    @property
    def name(self) -> str:
        return f"{self.begin}-{self.end}-{self.processed}"


@dataclass(frozen=True)
class Progress:
    """What a run has written, and what it found finished."""

    written: int
    skipped: int
    processed: int


def commits(spark: SparkSession, path: str) -> dict[int, Commit]:
    """The finished slices of a table by where they begin."""
    found: dict[int, Commit] = {}
    for name in files.names(spark, f"{path.rstrip('/')}/{COMMITS}"):
        parts = name.split("-")
        if not name.startswith(".") and len(parts) == 3:
            made = Commit(*map(int, parts))
            if made.begin not in found or found[made.begin].end < made.end:
                found[made.begin] = made
    return found


def processed(spark: SparkSession, path: str) -> int:
    """Blocks or events that the table's finished slices took; each slice counts once,
    however often it was written."""
    return sum(made.processed for made in commits(spark, path).values())


def keep_slices(spark: SparkSession, path: str, size: int, what: str) -> None:
    """Store a table's slice size and what it holds; refuse others."""
    if size <= 0:
        raise InvalidArgument(f"slices must not be empty: {size}")
    kept = int(note(spark, path, SLICE_NOTE, str(size)))
    if kept != size:
        raise InvalidArgument(f"{path} has slices of {kept}, not slices of {size}")
    held = note(spark, path, TABLE_NOTE, what)
    if held != what:
        raise InvalidArgument(f"{path} holds {held}, not {what}")


def write_slices(
    spark: SparkSession,
    path: str,
    begins: Iterator[int],
    end_of: Callable[[int], int],
    write: Callable[[int, int, str], int],
    at_once: int,
) -> Progress:
    """Write the slices that aren't finished up to their end, ``at_once`` at a time.

    ``write(begin, end, directory)`` writes one and says what it took. A slice that is
    finished only up to an earlier end is written again, whole: it counts as unfinished
    meanwhile. If one fails, no new one is begun and the failure is passed on, but those
    that were running are finished first.
    """
    path = path.rstrip("/")
    known = commits(spark, path)
    counts = {"written": 0, "skipped": 0, "processed": 0}

    def waiting() -> Iterator[int]:
        for begin in begins:
            if begin in known and known[begin].end >= end_of(begin):
                counts["skipped"] += 1
            else:
                yield begin

    def one(begin: int) -> int:
        if begin in known:
            files.remove(spark, f"{path}/{COMMITS}/{known[begin].name}")
        end = end_of(begin)
        took = write(begin, end, f"{path}/{SLICE}={begin}")
        files.create(spark, f"{path}/{COMMITS}/{Commit(begin, end, took).name}", "")
        return took

    left = waiting()
    with ThreadPoolExecutor(at_once) as pool:
        running = {pool.submit(one, begin) for begin in islice(left, at_once)}
        while running:
            done, running = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                counts["processed"] += future.result()
                counts["written"] += 1
            running |= {pool.submit(one, begin) for begin in islice(left, len(done))}
    return Progress(**counts)


def read_slices(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """The finished slices of a table, optionally only ``[start, end)``, as one table.

    The directories of slices outside the range are not read, nor those of slices
    that are not finished.
    """
    path = path.rstrip("/")
    done = commits(spark, path)
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(SLICE, T.LongType())])
    table = read_table(spark, path, schema, start=start, end=end)
    there = {int(n.partition("=")[2]) for n in files.names(spark, path) if n.startswith(f"{SLICE}=")}
    unfinished = sorted(there - set(done))
    if unfinished:
        table = table.where(~F.col(SLICE).isin(unfinished))
    if start is not None and end is not None:
        inside = [made.begin for made in done.values() if made.begin < end and made.end > start]
        table = table.where(F.col(SLICE).between(min(inside, default=0), max(inside, default=-1)))
    return table.drop(SLICE)
