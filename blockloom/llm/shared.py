"""Helpers that several operators use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import blockloom
from blockloom.session import CHECKPOINT_DIR, work_dir

#: White space between words, as a class of a Java pattern: \x20 and \x09-\x0D.
BLANK = r"[\x20\x09-\x0D]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that all executors share, see ``work_dir``.

    Only a local session, where one machine runs everything, gets one if it has none.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not named and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return work_dir(spark, purpose)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for a context.

    A cluster whose machines have it installed, or that got it as a zip, needs nothing.
    """
    context, root = spark.sparkContext, Path(blockloom.__file__).parent
    if not root.is_dir() or getattr(context, "_sent_blockloom", False):
        return
    archive = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="package-"), "blockloom.zip"))
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    context._sent_blockloom = True


def in_batches(run: Callable, schema: str | T.StructType) -> Callable[[DataFrame], DataFrame]:
    """For ``transform``: ``mapInArrow`` with a function of this package.

    Workers outlive their task: what batches took is given back when it ends.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    def mapped(df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        return df.mapInArrow(tidied, schema)

    return mapped


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    Writes a checkpoint to the folder of ``spark.checkpoint.dir``, which all
    executors share, so that losing an executor loses no rows.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def computed(df: DataFrame) -> DataFrame:
    """``df``, its columns computed once for whatever follows.

    A filter on a column is pushed below the steps that make it and takes their whole
    expressions along, into lambdas even, where they run for every element. Nothing
    is pushed through a generated row.
    """
    row = F.struct(*df.columns)
    return df.select(F.explode_outer(F.array(row)).alias("_row")).select("_row.*")


def spread_join(many: DataFrame, few: DataFrame, on: list[str], by: str, salts: int = 2) -> DataFrame:
    """Inner join of ``many`` with aggregated rows, ``few``, on the aggregation's keys.

    Joined as it is, all rows of a key must follow its aggregate to one task. The
    salt from column ``by`` deals a key over several, and the shuffles that it
    brings are ones that adaptive execution may split further.
    """
    salt = F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")
    copies = F.explode(F.array(*map(F.lit, range(salts))))
    joined = many.withColumn("_salt", salt).join(few.withColumn("_salt", copies), [*on, "_salt"])
    return joined.drop("_salt")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and only these, in lower case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def blank_split(text: Column) -> Column:
    """The words of ``text`` between white space, none for NULL."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")
    return words


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of them stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The UTF-8 of each text of a batch, empty for NULL."""
    for value in batch.column(column):
        yield (value.as_py() or "").encode()


def portions(
    batches: Iterator[pa.RecordBatch], key: str, column: str, rows: int = 512, size: int = 4_000_000
) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Keys and UTF-8 of a few texts at a time: at most ``rows``, and no more once they
    have ``size`` bytes. A longer text comes with those before it."""
    for batch in batches:
        keys, begin, held = batch.column(key), 0, []
        total = 0
        for at, text in enumerate(texts(batch, column), 1):
            held.append(text)
            total += len(text)
            if at - begin >= rows or total >= size or at == batch.num_rows:
                yield keys.slice(begin, at - begin), held
                begin, held, total = at, [], 0
