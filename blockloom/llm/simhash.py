"""Near-duplicate groups by SimHash, compared bit-sliced.

1. Every text gets a 64-bit fingerprint: bit k is 1 if it is set in over half of
   the hashes of its word shingles.
2. Equal fingerprints become one row, so copies cost nothing further on.
3. Fingerprints within the radius agree on at least one of ``radius + 1`` parts of
   their bits, so they are dealt into buckets by (part, its bits). A bucket of more
   than ``bucket`` fingerprints is dealt again, by parts of its remaining bits.
   Every level keeps every link. Once few bits remain, a bucket can't hold more
   than ``2 ** remaining`` fingerprints, however large the input is.
4. Buckets are compared as bit planes: plane k holds bit k of many fingerprints,
   64 to a word. The differences of all lanes at one shift are added up with
   carry-save counters, plane by plane, and a block is abandoned as soon as all of
   its lanes are past the radius. A bucket reports a spanning forest of its links,
   not all pairs.
5. Links become classes by the alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.components import smallest_reachable
from blockloom.llm.shared import in_batches, settle, texts

BITS = 64
BUCKET = 2048
BLOCK = 16384
#: Buckets are not dealt anew once so few bits are free: at most 2 ** FREE rows.
FREE = 16


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle of lower-cased ``text``, repeats included."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if len(words) <= shingle:
        grams = [b" ".join(words)] if words else []
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, seed) for g in grams), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of ``hashes`` have; 0 if there are none."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        octets = hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of lower-cased ``text``; 0 if it has no words."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``print`` (the bits as a BIGINT) of each row with doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle, seed) for t in texts(batch)]
            made = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made)], ["doc_id", "print"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").transform(in_batches(run, f"doc_id {kind}, print bigint"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _parts(mask: int, radius: int) -> list[int]:
    """``mask`` with one more part of the bits it leaves free, for each part."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    cuts = [round(i * len(free) / (radius + 1)) for i in range(radius + 2)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:])]


class Forest:
    """Disjoint sets over the rows of a block."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, k: int) -> int:
        root = self.root
        while root[k] != k:
            root[k] = k = root[root[k]]
        return int(k)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Join the pairs; those that joined two sets."""
        apart = self.root[a] != self.root[b]
        used = []
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            p, q = self.find(x), self.find(y)
            if p != q:
                self.root[max(p, q)] = min(p, q)
                used.append((x, y))
        if used:
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
        return used


def near_pairs(
    prints: np.ndarray, sizes: np.ndarray, radius: int = 3
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of all links inside consecutive buckets, some at a time.

    ``prints`` are the fingerprints, bucket after bucket; ``sizes`` the buckets'
    numbers of rows, none larger than the one before.
    """
    n = len(prints)
    octets = prints.astype("<u8").view(np.uint8).reshape(n, 8)
    lanes = np.unpackbits(octets, axis=1, bitorder="little").T
    words = (n + BITS - 1) // BITS
    planes = np.zeros((BITS, (2 * words + 2) * 8), np.uint8)
    packed = np.packbits(lanes, axis=1, bitorder="little")
    planes[:, : packed.shape[1]] = packed
    planes = planes.view("<u8")
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    counters = max(1, radius.bit_length())
    head_start = (1 << counters) - 1 - radius  # so that one more than radius overflows
    for shift in range(1, int(sizes[0]) if len(sizes) else 0):
        held = int(ends[np.searchsorted(-sizes, -shift, side="left") - 1])  # rows of larger buckets
        valid = np.zeros(((held + BITS - 1) // BITS) * BITS, bool)
        valid[: held - shift] = bucket[: held - shift] == bucket[shift:held]
        valid = np.packbits(valid, bitorder="little").view("<u8")
        w = len(valid)
        skip, part = divmod(shift, BITS)
        count = [np.full(w, -(head_start >> i & 1), np.int64).view("<u8") for i in range(counters)]
        over = ~valid
        for k in range(0, BITS, 8):
            other = planes[k : k + 8, skip : skip + w]
            if part:
                above = planes[k : k + 8, skip + 1 : skip + w + 1]
                other = other >> np.uint64(part) | above << np.uint64(BITS - part)
            for carry in planes[k : k + 8, :w] ^ other:
                for i in range(counters):
                    count[i], carry = count[i] ^ carry, count[i] & carry
                over = over | carry
            if (over == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
                break  # every lane is past the radius
        else:
            near = np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))
            yield near, near + shift


def linked(prints: np.ndarray, sizes: np.ndarray, radius: int = 3) -> list[tuple[int, int]]:
    """A spanning forest of the links of ``near_pairs``."""
    forest, found = Forest(len(prints)), []
    for a, b in near_pairs(prints, sizes, radius):
        found += forest.join(a, b)
    return found


def compare(find: Callable[[pa.Table, np.ndarray], Iterator[np.ndarray]]):
    """Rows sorted by bucket to links; a bucket never spans two partitions.

    ``find`` takes the rows, bucket after bucket, and the buckets' descending sizes; it
    gives the links some at a time, which none has to hold together.
    """

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        masks, keys = rows["mask"].to_numpy(), rows["key"].to_numpy()
        new = np.ones(len(masks), bool)
        new[1:] = (masks[1:] != masks[:-1]) | (keys[1:] != keys[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(masks)))
        order = np.argsort(-sizes, kind="stable")
        pick = np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in order])
        rows = rows.combine_chunks().take(pa.array(pick))
        names = rows["rep"].combine_chunks()
        held, n = [], 0
        for some in find(rows, sizes[order]):
            held.append(some)
            n += len(some)
            if n >= BLOCK:
                yield named(names, held)
                held, n = [], 0
        if n:
            yield named(names, held)

    def named(names: pa.Array, held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate(held)
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(pairs[:, 0])), names.take(pa.array(pairs[:, 1]))], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < BLOCK:
                continue
            rows = pa.Table.from_batches(held)
            masks, keys = rows["mask"].to_numpy(), rows["key"].to_numpy()
            tail = np.flatnonzero((masks != masks[-1]) | (keys != keys[-1]))
            cut = int(tail[-1]) + 1 if len(tail) else 0  # the last bucket may go on
            if cut:
                yield from block(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
            n -= cut
        if n:
            yield from block(pa.Table.from_batches(held))

    return run


def links(reps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``a`` and ``b``: enough links between the ``rep`` of distinct ``print``s.

    Two fingerprints are joined by a chain of these rows exactly when a chain of
    pairs at ``radius`` or fewer differing bits joins them.
    """
    masks, free, pending, ready = _parts(0, radius), BITS, reps, []
    parents: dict[int, list[int]] = {}
    while True:
        free -= free // (radius + 1)
        if parents:
            children = F.create_map(
                *(
                    F.lit(x) if isinstance(x, int) else F.array(*map(F.lit, x))
                    for mask, own in parents.items()
                    for x in (_signed(mask), [_signed(m) for m in own])
                )
            )
            dealt = pending.withColumn("mask", F.explode(F.element_at(children, F.col("mask"))))
        else:
            dealt = pending.select(
                F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"),
                "print",
                "rep",
            )
        dealt = dealt.withColumn("key", F.col("print").bitwiseAND(F.col("mask")))
        counts = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        counts = settle(counts)
        last = free <= FREE
        small = counts if last else counts.filter(F.col("n") <= bucket)
        ready.append(dealt.join(small.select("mask", "key"), ["mask", "key"]))
        large = counts.filter(F.col("n") > bucket)
        if last or large.isEmpty():
            break
        pending = (
            dealt.join(large.select("mask", "key"), ["mask", "key"])
            .select("mask", "print", "rep")
            .distinct()
        )
        parents = {m: _parts(m, radius) for m in masks}
        masks = [m for own in parents.values() for m in own]
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)

    def forest(rows: pa.Table, sizes: np.ndarray) -> Iterator[np.ndarray]:
        found = linked(rows["print"].to_numpy().view(np.uint64), sizes, radius)
        yield np.array(found, np.int64).reshape(-1, 2)

    kind = reps.schema["rep"].dataType.simpleString()
    # Not by the columns themselves: where the join has dealt by them, this shuffle would be
    # left out, and reading the join's input locally or in pieces parts buckets.
    return (
        rows.select("mask", "key", "print", "rep")
        .repartition(F.xxhash64("mask", "key"))
        .sortWithinPartitions("mask", "key")
        .transform(in_batches(compare(forest), f"a {kind}, b {kind}"))
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """One row per row of ``docs``: doc_id, print and component_id.

    ``component_id`` is the smallest doc_id that links lead to. NULL, empty and
    blank texts have fingerprint 0 and link like any other. Repeated rows are
    returned as often as they come. A row without doc_id is grouped by its
    fingerprint, but names no group: its component_id is that of the documents
    with the same fingerprint, NULL if there are none. Other columns are dropped.
    An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, shingle))
    reps = settle(
        prints.filter("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("rep"))
    )
    classes = smallest_reachable(links(reps, radius, bucket))
    named = reps.join(classes, reps["rep"] == classes["node"], "left").select(
        "print", F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(named, "print", "left").select("doc_id", "print", "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents whose group has a smaller doc_id.

    Rows without doc_id stay unless a document with an id has their fingerprint.
    Of repeated rows with the same doc_id all stay.
    """
    groups = near_duplicates(docs, **options)
    gone = groups.filter("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    return kept
