"""Removal of passages that repeat across documents.

Every window of ``window`` consecutive words gets a Rabin-Karp hash, rolled along
the document, and a window is removed if the same words start in a document with a
smaller doc_id. Shuffling a row for every window would move several times the
input, so windows are counted in Spark in runs:

1. The *anchor* of a window is the smallest Rabin-Karp hash of the ``GRAM``-word
   sequences in it. Equal windows have equal anchors, whatever stands around them.
   Consecutive windows with one anchor are a run, about 22 windows; its key is a
   hash of its windows' hashes.
2. Runs are counted by anchor. An anchor that one document has can't be part of a
   repeat across documents, and its windows need no further look.
3. Of the rest, runs are counted by key: a run that also starts in a smaller
   document is covered as a whole.
4. Runs that share an anchor but differ may still share windows. The first document
   of each such run gives out its windows one by one, and these are counted.
5. Covered runs and windows go back to their documents, where they are merged into
   maximal intervals of words to remove.

Counting is a partial aggregation followed by a join that adaptive execution may
split, so a passage that a third of all documents share loads no single task. What
is gathered for a document is bounded by that document's own runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.llm.shared import in_batches, settle, shared_dir, slices, spread_join, texts

WINDOW = 50
GRAM = 8
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPANS = "array<struct<start:bigint,stop:bigint>>"

_ONE = np.uint64(1)


class _Words(dict):
    """Hashes of words, forgotten when there are too many."""

    most = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


def _forget() -> None:
    """For the end of a task: an idle worker keeps no memory that others need. A function
    that is sent to workers would take a copy of the hashes along; it finds this one by name."""
    _WORDS.clear()


class _Powers:
    """Powers of an odd base modulo 2 ** 64, and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_WORDS = _Words()
#: Bases of the window and of the anchor hashes, odd numbers without a pattern.
_WINDOWS, _ANCHORS = _Powers(0x9E3779B97F4A7C15), _Powers(0xD1B54A32D192ED03)


def _mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit over the word; one to one."""
    values = (values ^ values >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ values >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ values >> np.uint64(32)


def rolling(ids: np.ndarray, width: int, powers: _Powers) -> np.ndarray:
    """Rabin-Karp hashes of all ``width``-long windows of ``ids``, by prefix sums."""
    n = len(ids)
    powers.reach(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(ids * powers.up[:n], out=sums[1:])
    return _mix((sums[width:] - sums[:-width]) * powers.down[: n - width + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    step, least = 1, values
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return least if step == width else np.minimum(least[: step - width], least[width - step :])


class Runs:
    """The windows of a text: hashes, and where runs of one anchor begin."""

    def __init__(self, words: list[bytes], window: int = WINDOW):
        gram = min(GRAM, window)
        ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
        self.windows = rolling(ids, window, _WINDOWS)
        anchors = _least(rolling(ids, gram, _ANCHORS), window - gram + 1)
        new = np.ones(len(anchors), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        self.starts = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.starts, len(anchors)))
        self.anchors = anchors[self.starts]
        place = np.arange(len(anchors)) - np.repeat(self.starts, self.sizes)
        whole = np.add.reduceat(self.windows * _WINDOWS.up[place], self.starts)
        self.keys = _mix(whole + self.sizes.astype(np.uint64))

    def within(self, chosen: np.ndarray) -> np.ndarray:
        """Which windows lie in the chosen runs."""
        return np.repeat(chosen, self.sizes)


def _repeat(column: pa.Array, counts: list[int]) -> pa.Array:
    return column.take(pa.array(np.repeat(np.arange(len(counts)), counts)))


def _long(parts: list[np.ndarray]) -> pa.Array:
    whole = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.array(whole.view(np.int64))


def _runs(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            anchors, keys, counts = [], [], []
            for text in texts(batch):
                words = text.split()
                if len(words) < window:
                    counts.append(0)
                    continue
                runs = Runs(words, window)
                own = np.unique(np.stack([runs.anchors, runs.keys]), axis=1)
                anchors.append(own[0])
                keys.append(own[1])
                counts.append(own.shape[1])
            yield pa.RecordBatch.from_arrays(
                [_repeat(batch.column("doc_id"), counts), _long(anchors), _long(keys)],
                ["doc_id", "anchor", "run"],
            )
        _forget()

    return run


def _windows(window: int):
    """The windows of wanted runs, each once for a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            anchors, hashes, counts = [], [], []
            for text, wanted in zip(texts(batch), batch.column("wanted")):
                words = text.split()
                if len(words) < window:
                    counts.append(0)
                    continue
                runs = Runs(words, window)
                keys = wanted.values.to_numpy().view(np.uint64)
                inside = runs.within(np.isin(runs.keys, keys))
                pairs = np.stack([np.repeat(runs.anchors, runs.sizes)[inside], runs.windows[inside]])
                own = np.unique(pairs, axis=1)
                anchors.append(own[0])
                hashes.append(own[1])
                counts.append(own.shape[1])
            yield pa.RecordBatch.from_arrays(
                [_repeat(batch.column("doc_id"), counts), _long(anchors), _long(hashes)],
                ["doc_id", "anchor", "hash"],
            )
        _forget()

    return run


def intervals(covered: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word intervals [start, stop) of the windows marked in ``covered``."""
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    apart = np.flatnonzero(np.diff(at) > window)  # neither overlapping nor touching
    first, last = np.append(at[0], at[apart + 1]), np.append(at[apart], at[-1])
    return list(zip(first.tolist(), (last + window).tolist()))


def _cut(text: bytes, spans: list[tuple[int, int]], n: int) -> bytes:
    """``text`` without the words of ``spans`` and the white space behind each."""
    starts = [m.start() for m in WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at : starts[start]])
        at = starts[stop]
    kept.append(text[at:])
    return b"".join(kept) if sum(b - a for a, b in spans) < n else b""


def _remove(window: int, carry: list[str]):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, n_removed, all_spans, kept = [], [], [], []
            for text, keys, hashes in zip(texts(batch), batch.column("runs"), batch.column("hashes")):
                words = text.split()
                spans: list[tuple[int, int]] = []
                if len(words) >= window and (keys.is_valid or hashes.is_valid):
                    runs = Runs(words, window)
                    covered = np.zeros(len(runs.windows), bool)
                    if keys.is_valid:
                        covered |= runs.within(np.isin(runs.keys, keys.values.to_numpy().view(np.uint64)))
                    if hashes.is_valid:
                        covered |= np.isin(runs.windows, hashes.values.to_numpy().view(np.uint64))
                    spans = intervals(covered, window)
                n_words.append(len(words))
                n_removed.append(sum(b - a for a, b in spans))
                all_spans.append([{"start": a, "stop": b} for a, b in spans])
                kept.append((_cut(text, spans, len(words)) if spans else text).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carry]
                + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                + [pa.array(all_spans, spans_type), pa.array(kept, pa.string())],
                [*carry, "n_words", "n_removed", "spans", "kept_text"],
            )
        _forget()

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns, n_words, n_removed,
    spans (maximal intervals of removed words, stop excluded) and kept_text.

    Words stand between ASCII white space. kept_text is the text without the removed
    words and the white space behind each; it is unchanged where nothing is removed,
    and empty for NULL texts and where all words go. Only documents with a smaller
    doc_id count, so repeats inside a document, and between rows with the same
    doc_id, stay. A row without doc_id is neither cut nor does it cut others. A
    carried column named like a result gives way to it; other columns are dropped.
    """
    own = ("doc_id", "text", "n_words", "n_removed", "spans", "kept_text", "runs", "hashes")
    carry = [c for c in carry if c not in own]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", *carry)

    runs = keyed.select("doc_id", "text").transform(in_batches(
        _runs(window), f"doc_id {id_type}, anchor bigint, run bigint"
    ))
    # Counted and joined: hash the texts once.
    stored, schema = f"{shared_dir(docs.sparkSession, 'substrings')}/runs", runs.schema
    runs.write.parquet(stored)
    runs = docs.sparkSession.read.schema(schema).parquet(stored)
    anchors = runs.groupBy("anchor").agg(
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
        (F.min("run") != F.max("run")).alias("mixed"),
    )
    shared = settle(
        spread_join(runs, anchors.filter("least < most"), ["anchor"], "doc_id").select(
            "doc_id", "anchor", "run", "mixed"
        )
    )
    first = shared.groupBy("anchor", "run").agg(F.min("doc_id").alias("first"))
    found = spread_join(shared, first, ["anchor", "run"], "doc_id").select(
        "doc_id", "run", "first", "mixed"
    )

    wanted = found.filter("mixed AND doc_id = first").groupBy("doc_id").agg(
        F.collect_set("run").alias("wanted")
    )
    # Neither settled nor without the carried columns: so this join and the last one are of
    # one job and of equal rows, and Spark shuffles the texts once for both.
    single = (
        keyed.join(wanted, "doc_id")
        .select("doc_id", "text", *carry, "wanted")
        .transform(in_batches(_windows(window), f"doc_id {id_type}, anchor bigint, hash bigint"))
    )
    repeated = single.groupBy("anchor", "hash").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    hits = spread_join(single, repeated.filter("first < last"), ["anchor", "hash"], "doc_id")
    hits = hits.filter("doc_id > first")

    none = F.lit(None).cast("bigint")
    marks = (
        found.filter("doc_id > first")
        .select("doc_id", "run", none.alias("hash"))
        .unionByName(hits.select("doc_id", none.alias("run"), "hash"))
        .groupBy("doc_id")
        .agg(F.collect_set("run").alias("runs"), F.collect_set("hash").alias("hashes"))
    )
    ready = keyed.join(marks, "doc_id", "left").unionByName(
        docs.filter("doc_id IS NULL").select("doc_id", "text", *carry), allowMissingColumns=True
    )
    schema = T.StructType([docs.schema[c] for c in ("doc_id", *carry)])
    for field in T.StructType.fromDDL(
        f"n_words bigint, n_removed bigint, spans {SPANS}, kept_text string"
    ):
        schema = schema.add(field)
    return ready.transform(in_batches(_remove(window, ["doc_id", *carry]), schema))
