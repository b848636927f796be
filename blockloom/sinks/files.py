"""Small files beside a table, on whatever file system the table lies."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, hidden entries too; nothing if it isn't there."""
    place, system = _open(spark, path)
    if not system.exists(place):
        return []
    return [found.getPath().getName() for found in system.listStatus(place)]


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a line of text; False, and nothing changed, if there is one.

    The text is written under a hidden name and renamed, so nobody reads half of it.
    """
    place, system = _open(spark, path)
    if system.exists(place):
        return False
    hidden = f"{place.getParent().toString()}/.{place.getName()}.{uuid.uuid4().hex}"
    waiting, _ = _open(spark, hidden)
    out = system.create(waiting, False)
    try:
        out.write(bytearray(f"{text}\n".encode()))
    finally:
        out.close()
    try:
        moved = system.rename(waiting, place)
    except Py4JJavaError:
        if not system.exists(place):
            raise
        moved = False
    if not moved:
        system.delete(waiting, False)
        if not system.exists(place):
            raise OSError(f"could not write {path}")
    return bool(moved)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a single file, if it is there."""
    place, system = _open(spark, path)
    system.delete(place, False)


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or of the only part in a folder; None if there is none."""
    place, system = _open(spark, path)
    if not system.exists(place):
        return None
    if system.getFileStatus(place).isDirectory():
        parts = sorted(name for name in names(spark, path) if name.startswith("part-"))
        return read(spark, f"{path}/{parts[0]}") if parts else None
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").rstrip("\n")
    finally:
        stream.close()
