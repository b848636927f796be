"""Runs of words: stretches that repeat with a period, and texts without the repeats.

A run is a stretch with smallest period q and at least ``max(LEAST, EXPONENT * q)``
words that no neighbouring word extends. Runs are found by string synchronising sets.
At the dyadic scale s = 8, 16, 32, ... each position has a hash of the s words that
follow. A position is selected if its hash, or that of the position s further on, is
the least of the s + 1 hashes from it on: whether it is depends on 2s words alone, so
equal contexts are selected alike. Two selected positions with the same 2s words, one
after the other and s to 2s - 1 apart, propose their distance as a period; comparing
words confirms it and gives the run's ends.

Why nothing is missed: in a run of period p, s <= p < 2s, with 4p words, some position
among the first s is selected, with its equal p further on, inside the run. That
fails only where 3s - 1 words have a period of s / 4 at most, which a run of period p
can't contain. Such windows, known from the runs of smaller periods, take no part in
the selection, so a text of one repeated word doesn't select all its positions. Periods
under 8 come from comparing all words with those 1 to 7 further on.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from blockloom.llm.shared import in_batches, portions

#: Words a run must have, and how often its period.
LEAST, EXPONENT = 6, 4
#: The smallest scale; shorter periods are compared directly.
SCALE = 8

_OUT = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEPS = ((np.uint64(30), np.uint64(0xBF58476D1CE4E5B9)), (np.uint64(27), np.uint64(0x94D049BB133111EB)))

RUN = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType())


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair."""
    made = first * _ODD + second
    for shift, factor in _STEPS:
        made ^= made >> shift
        made *= factor
    made ^= made >> np.uint64(31)
    return made


def _doubled(names: np.ndarray, span: int) -> np.ndarray:
    """Hashes of 2 * span words from those of span words."""
    return _mixed(names[:-span], names[span:])


def _stretch(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Start and end of the longest stretch of a period around ``at``, where it holds."""
    high, step = at, 64
    while high < len(ids) - period:
        stop = min(len(ids) - period, high + step)
        differ = ids[high:stop] != ids[high + period : stop + period]
        first = int(differ.argmax())
        if differ[first]:
            high += first
            break
        high, step = stop, step * 2
    low, step = at, 64
    while low > 0:
        stop = max(0, low - step)
        differ = ids[stop:low] != ids[stop + period : low + period]
        first = int(differ[::-1].argmax())
        if differ[::-1][first]:
            low -= first
            break
        low, step = stop, step * 2
    return low, high + period


def _keep(found: dict[tuple[int, int], int], start: int, end: int, period: int) -> None:
    """A stretch that also has a smaller period is that period's run."""
    if end - start >= max(LEAST, EXPONENT * period):
        found[start, end] = min(period, found.get((start, end), period))


def _short_periods(ids: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    for period in range(1, min(SCALE, len(ids))):
        same = np.zeros(len(ids) - period + 2, dtype=bool)
        np.equal(ids[:-period], ids[period:], out=same[1:-1])
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[::2], edges[1::2] + period
        long = ends - starts >= max(LEAST, EXPONENT * period)
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            _keep(found, start, end, period)


def _selected(names: np.ndarray, span: int, found: dict[tuple[int, int], int]) -> np.ndarray:
    """The synchronising set of a scale: selected positions, ascending."""
    names = names.copy()
    for (start, end), period in found.items():
        if 4 * period <= span <= end - start:
            names[start : end - span + 1] = _OUT
    low, width = names, 1
    while width < span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:-1], low[1:])
    least = (names[: len(low)] == low) | (names[span : span + len(low)] == low)
    return np.flatnonzero(least & (low != _OUT))


def find(ids: np.ndarray, longest: Callable[[int], int]) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of a sequence of numbers, in order.

    ``longest(k)`` is how much of the sequence, from its beginning, can hold runs of k
    words; at large scales the rest is left out.
    """
    found: dict[tuple[int, int], int] = {}
    _short_periods(ids, found)
    names, span = _mixed(ids.astype(np.uint64), np.zeros(len(ids), dtype=np.uint64)), 1
    while True:
        size = longest(EXPONENT * span)
        ids, names = ids[:size], names[: max(0, size - span + 1)]
        if size < EXPONENT * span:
            break
        contexts = _doubled(names, span)
        if span >= SCALE:
            at = _selected(names, span, found)
            order = np.argsort(contexts[at], kind="stable")
            context, at = contexts[at][order], at[order]
            gap = at[1:] - at[:-1]
            near = (context[1:] == context[:-1]) & (gap >= span) & (gap < 2 * span)
            end, last = 0, 0
            for period, place in sorted(zip(gap[near].tolist(), at[:-1][near].tolist())):
                if period == last and place < end - period:
                    continue  # in the stretch found before
                start, end = _stretch(ids, place, period)
                last = period
                if start <= place < end - period:
                    _keep(found, start, end, period)
        names, span = contexts, 2 * span
    return sorted((start, end, period) for (start, end), period in found.items())


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start and period.

    Long lists come first in one array, a number of its own between any two, so that
    each scale reads only those that are long enough.
    """
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    numbers: dict = defaultdict(count().__next__)
    ids: list[int] = []
    starts, sizes = [], []
    for place, k in enumerate(order):
        starts.append(len(ids))
        sizes.append(len(texts[k]))
        ids.extend(map(numbers.__getitem__, texts[k]))
        ids.append(-1 - place)
    lengths = -np.array(sizes, dtype=np.int64)

    def longest(words: int) -> int:
        n = int(np.searchsorted(lengths, -words, side="right"))
        return starts[n] if n < len(starts) else len(ids)

    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not ids:
        return out
    for start, end, period in find(np.array(ids, dtype=np.int64), longest):
        place = int(np.searchsorted(starts, start, side="right")) - 1
        out[order[place]].append((start - starts[place], end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run has after its first period."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = list(compress(words, kept))
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs and collapsed.

    runs is an array of (start, length, period), numbered in words from 0, by start and
    then period; collapsed is the text with one period left of every run. Words are what
    stands between white space (0x20, 0x09 to 0x0D). NULL, empty and blank texts have no
    words, no runs and an empty collapsed text. Runs that share words are all
    returned; a word goes if any of them drops it. Repeated rows are all returned, an
    empty table gives none, other columns are dropped. A text is one row whatever its
    length: memory is proportional to the longest text, time nearly so. ``alter`` gets
    doc_id and words and returns the words to look at.
    """
    schema = (
        T.StructType([docs.schema["doc_id"]])
        .add("n_words", T.LongType())
        .add("runs", T.ArrayType(RUN))
        .add("collapsed", T.StringType())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in portions(batches, "doc_id", "text"):
            words = [text.split() for text in texts]
            if alter is not None:
                words = [alter(key, w) for key, w in zip(ids.to_pylist(), words)]
            found = runs_of(words)
            rows = np.array(list(chain.from_iterable(found)), dtype=np.int64).reshape(-1, 3)
            ends = np.cumsum([0, *map(len, found)])
            parts = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], RUN.names)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(list(map(len, words)), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts),
                    pa.array([collapsed(*pair).decode() for pair in zip(words, found)], pa.string()),
                ],
                schema.names,
            )

    return docs.select("doc_id", "text").transform(in_batches(run, schema))
