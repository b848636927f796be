"""Near copies by Jaccard similarity, found by SimHash and checked exactly.

Texts whose word shingles are similar differ in too many bits of a SimHash for parts of
these bits to find them: at a similarity of 0.8 about ten of 64. So here

1. every text gets a SimHash of its distinct shingles, and ``BANDS`` keys, each made of
   ``ROWS`` least hashes; texts of similarity 0.8 share one of the keys with a
   probability over 0.999;
2. texts of equal shingles become one row, so copies cost nothing further on;
3. texts that share a key are a bucket; one of more than ``bucket`` texts is first dealt
   into parts of about that many, whose texts are compared;
4. buckets are compared as bit planes, as in ``simhash``, with ascending radii: links of
   few differing bits are taken first, and a bucket gives a few spanning forests of them
   instead of all pairs;
5. of these links only those are kept whose texts can be similar enough: a text carries
   the parity of its shingles' number in each of many cells, two texts differ by at least
   as many shingles as parities, and a link that this rules out couldn't hold. What goes
   on are real links and near misses, not all pairs of a group of unlike texts;
6. they are checked by the exact similarity of their shingles;
7. links that hold become classes, and buckets of several classes are compared again, with
   more forests, until no link between two classes is left unchecked. Of a large bucket
   every two parts are compared then, unless both are of one class, each two as a bucket
   of their own: nothing in it is left out, and no task takes it whole.

A link is lost only where no bucket holds its two texts or where their fingerprints differ
by more than the last radius. Tests hold the recall against all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.components import smallest_reachable
from blockloom.llm.shared import in_batches, portions, shared_dir, spread_join
from blockloom.llm.simhash import Forest, compare, majority, near_pairs, shingle_hashes

BANDS = 16
ROWS = 4
BUCKET = 8192
RADII = (4, 8, 12, 16, 24)
#: Bits of a text's parities: the power of two from three for a shingle on, within these.
CELLS = (256, 16384)
#: Forests that a round keeps at most; the one after takes all links as they are.
FORESTS = 512
#: Ids sent to every task, 8 bytes each; more are joined by a shuffle.
SENT = 500_000

_draw = np.random.Generator(np.random.PCG64(42))
_FACTORS = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_OFFSETS = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """The keys of distinct shingle hashes; none if there are no hashes."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for k in range(0, len(hashes), 4096):
        mixed = hashes[None, k : k + 4096] * _FACTORS[:, None] + _OFFSETS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    octets = least.astype("<u8").reshape(BANDS, ROWS)
    return [int.from_bytes(xxhash.xxh64_digest(o.tobytes()), "big", signed=True) for o in octets]


def parities(hashes: np.ndarray) -> bytes:
    """Whether each cell has an odd number of distinct hashes; a hash's last bits are its cell."""
    cells = min(max(CELLS[0], 1 << (3 * len(hashes) - 1).bit_length()), CELLS[1])
    counts = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


class Apart:
    """How many shingles at least only one of two texts has."""

    def __init__(self, sizes: np.ndarray, held: list[bytes]):
        self.sizes, self.widths = sizes, np.array([len(x) for x in held], np.int64)
        self.folded, self.place = {}, {}
        for width in np.unique(self.widths).tolist():
            rows = np.flatnonzero(self.widths >= width)
            self.place[width] = np.zeros(len(held), np.int64)
            self.place[width][rows] = np.arange(len(rows))
            # Of half as many cells one has the hashes of two, and the parity of their sum.
            parts = [np.frombuffer(held[k], "<u8").reshape(-1, width // 8) for k in rows.tolist()]
            self.folded[width] = np.stack([np.bitwise_xor.reduce(x, axis=0) for x in parts])

    def possible(self, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
        """Which pairs of rows can have a similarity of ``least``; none that has is left out."""
        both = self.sizes[a] + self.sizes[b]
        most = both * (1 - least) / (1 + least) + 1e-6
        able = np.abs(self.sizes[a] - self.sizes[b]) <= most
        width = np.minimum(self.widths[a], self.widths[b])
        for w, table in self.folded.items():
            at = np.flatnonzero(able & (width == w))
            place = self.place[w]
            for k in range(0, len(at), 8192):
                some = at[k : k + 8192]
                odd = np.bitwise_count(table[place[a[some]]] ^ table[place[b[some]]])
                able[some] = odd.sum(axis=1, dtype=np.int64) <= most[some]
        return able


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in portions(batches, "doc_id", "text"):
            digests, prints, keys, sizes, odd = [], [], [], [], []
            for text in held:
                hashes = np.unique(shingle_hashes(text, shingle))
                digests.append(xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes()))
                prints.append(majority(hashes))
                keys.append(band_keys(hashes))
                sizes.append(len(hashes))
                odd.append(parities(hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(digests, pa.binary()),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(odd, pa.binary()),
                ],
                ["doc_id", "digest", "print", "keys", "size", "odd"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in portions(batches, "doc_id", "text"):
            made = [np.unique(shingle_hashes(text, shingle)).view(np.int64) for text in held]
            sets = pa.array(made, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, sets], ["doc_id", "hashes"])

    return run


def buckets(reps: DataFrame) -> DataFrame:
    """``mask``, ``key``, ``print``, ``rep`` and ``n``: the texts that share a key, and how many."""
    dealt = reps.select(F.posexplode("keys").alias("mask", "key"), "print", "rep")
    counts = settle(dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"))
    rows = spread_join(dealt, counts, ["mask", "key"], "rep")
    return rows.select(F.col("mask").cast("bigint"), "key", "print", "rep", "n")


def parts(rows: DataFrame, bucket: int) -> DataFrame:
    """``rows`` of ``buckets``, the large ones dealt into parts of about ``bucket`` texts."""
    part = F.pmod(F.xxhash64("rep", "mask"), F.ceil(F.col("n") / bucket))
    return rows.withColumn("key", F.when(F.col("n") > bucket, F.xxhash64("key", part)).otherwise(F.col("key")))


def paired(rows: DataFrame, bucket: int) -> DataFrame:
    """Large buckets as buckets of two parts each: any two texts of different ``component``
    are together in one.

    A part has about half of ``bucket`` texts, of one component if that has more, else
    whole components. Two parts of one component are not put together.
    """
    half, place = max(1, bucket // 2), ["mask", "key"]
    sizes = settle(rows.groupBy(*place, "component").agg(F.count("*").alias("own")))
    large = F.col("own") > half
    several = sizes.groupBy(*place).agg(F.sum(F.when(~large, F.col("own"))).alias("rest"))
    sizes = sizes.join(several, place).select(
        *place, "component", large.alias("large"), F.ceil(F.when(large, F.col("own")).otherwise(F.col("rest")) / half).alias("of")
    )
    deal = F.when(F.col("large"), F.xxhash64("rep", "mask")).otherwise(F.xxhash64("component", "mask"))
    dealt = spread_join(rows, sizes, [*place, "component"], "rep")
    dealt = dealt.withColumn("whole", F.when(F.col("large"), F.col("component")))
    dealt = settle(dealt.withColumn("part", F.xxhash64("whole", F.pmod(deal, F.col("of")))))
    one = dealt.select(*place, "whole", "part").distinct()
    other = one.select(*place, F.col("whole").alias("whole2"), F.col("part").alias("part2"))
    apart = F.col("whole").isNull() | F.col("whole2").isNull() | (F.col("whole") != F.col("whole2"))
    alone = (F.col("part") == F.col("part2")) & F.col("whole").isNull()
    pairs = one.join(other, place).filter(((F.col("part") < F.col("part2")) & apart) | alone)
    pair = F.xxhash64(*place, "part", "part2").alias("pair")
    members = pairs.select(*place, pair, F.explode(F.array_distinct(F.array("part", "part2"))).alias("part"))
    return dealt.join(members, [*place, "part"]).select(
        "mask", F.col("pair").alias("key"), "print", "rep", "component"
    )


def _forests(number: int | None, radii: tuple[int, ...], least: float):
    """Links between classes that may hold, the nearest first: at most ``number`` forests
    of them, or all without a number.

    A link that lies in none of them gives its first row twice: there is more to do.
    """

    def find(rows: pa.Table, sizes: np.ndarray) -> Iterator[np.ndarray]:
        prints = rows["print"].to_numpy().view(np.uint64)
        names, own = np.unique(rows["component"].to_numpy(), return_inverse=True)
        apart = Apart(rows["size"].to_numpy(), rows["odd"].to_pylist())
        forests: list[Forest] = []
        more = False
        for low, high in zip((-1, *radii), radii):
            for a, b in near_pairs(prints, sizes, high):
                new = (own[a] != own[b]) & (np.bitwise_count(prints[a] ^ prints[b]) > low)
                a, b = a[new], b[new]
                can = apart.possible(a, b, least)
                a, b = a[can], b[can]
                if number is None:
                    yield np.stack([a, b], axis=1)
                    continue
                if len(forests) == number:
                    # what the last forest has joined, all have
                    last = forests[-1]
                    while not np.array_equal(up := last.root[last.root], last.root):
                        last.root = up
                    open_ = last.root[own[a]] != last.root[own[b]]
                    if not open_.all():
                        if not more:
                            yield np.array([(a[0], a[0])])
                        more = True
                    a, b = a[open_], b[open_]
                found = []
                for x, y in zip(a.tolist(), b.tolist()):
                    p, q, begin, end = own[x], own[y], 0, len(forests)
                    while begin < end:  # the first forest that hasn't joined them
                        middle = (begin + end) // 2
                        if forests[middle].find(p) == forests[middle].find(q):
                            begin = middle + 1
                        else:
                            end = middle
                    if begin == number:
                        if not more:
                            found.append((x, x))
                        more = True
                        continue
                    if begin == len(forests):
                        forests.append(Forest(len(names)))
                    forest = forests[begin]
                    p, q = forest.find(p), forest.find(q)
                    forest.root[max(p, q)] = min(p, q)
                    found.append((x, y))
                if found:
                    yield np.array(found)

    return find


def classes(
    docs: DataFrame,
    rows: DataFrame,
    marks: DataFrame,
    shingle: int,
    least: float,
    bucket: int = BUCKET,
    radii: tuple[int, ...] = RADII,
) -> DataFrame:
    """``a`` and ``b``: checked links between the ``rep``s of ``rows``, made by ``buckets``.

    ``marks`` has the ``size`` and parities of each ``rep`` and ``print``. Round by round,
    only buckets that hold several classes still are compared, large ones by all pairs of
    their parts. Each round takes sixteen times as many forests, until they hold all links
    between classes that may hold; after ``FORESTS`` of them a round takes the rest at once.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["rep"].dataType.simpleString()
    any_large = not rows.filter(F.col("n") > bucket).isEmpty()
    found, number = None, 2
    while True:
        complete = found is not None or not any_large
        if found is None:
            now = parts(rows, bucket).withColumn("component", F.col("rep"))
        else:
            roots = settle(smallest_reachable(found))
            now = rows.join(roots, rows["rep"] == roots["node"], "left")
            now = now.select("mask", "key", "print", "rep", "n", F.coalesce("root", "rep").alias("component"))
            ends = now.groupBy("mask", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            now = spread_join(now, ends.filter("low < high").drop("low", "high"), ["mask", "key"], "rep")
            if any_large:
                now = settle(now)
                large = paired(now.filter(F.col("n") > bucket).drop("n"), bucket)
                now = now.filter(F.col("n") <= bucket).drop("n").unionByName(large)
        linked = settle(
            now.join(marks, ["rep", "print"])
            .select("mask", "key", "print", "rep", "component", "size", "odd")
            # few bytes, much to compare: a number keeps the tasks from being put together
            .repartition(tasks, "mask", "key")
            .sortWithinPartitions("mask", "key", "rep")
            .transform(in_batches(compare(_forests(number, radii, least)), f"a {kind}, b {kind}"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        held = checked(docs, linked.filter("a < b"), shingle, least)
        found = settle(held if found is None else found.unionByName(held).distinct())
        if complete and linked.filter("a = b").isEmpty():
            return found
        number = number * 16 if number and number < FORESTS else None


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.

    A checkpoint keeps the plan's estimate of its size, and such estimates, multiplied
    join after join, outgrow all numbers in a few rounds; a table has its real size.
    """
    path = f"{shared_dir(df.sparkSession, 'similar')}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= SENT else ids


def checked(docs: DataFrame, links: DataFrame, shingle: int, least: float) -> DataFrame:
    """The rows of ``links`` whose documents' shingles have at least that similarity."""
    ends = links.select(F.col("a").alias("doc_id")).union(links.select("b")).distinct()
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", "text").join(_few(settle(ends)), "doc_id", "left_semi")
    sets = named.transform(in_batches(_sets(shingle), f"doc_id {kind}, hashes array<bigint>"))
    sets = settle(sets.groupBy("doc_id", F.xxhash64("hashes")).agg(F.first("hashes").alias("hashes")))
    pairs = spread_join(links, sets.selectExpr("doc_id AS a", "hashes AS ours"), ["a"], "b")
    pairs = spread_join(pairs, sets.selectExpr("doc_id AS b", "hashes AS theirs"), ["b"], "a")
    common = F.size(F.array_intersect("ours", "theirs"))
    either = F.size("ours") + F.size("theirs") - common
    return pairs.filter(common >= F.lit(least) * either - 1e-9).select("a", "b").distinct()


def groups(
    docs: DataFrame, shingle: int = 5, least: float = 0.8, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest doc_id that links lead to.

    Texts are linked if the Jaccard similarity of their sets of word shingles is at least
    ``least``. NULL, empty and blank texts have none and are all linked; texts of fewer
    words than a shingle have one, their whole sequence. A text is taken whole however
    long it is. Repeated rows with one doc_id are one document, whatever their texts;
    there is one row per document. Rows without doc_id give none and link nothing. Other
    columns are dropped. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, digest binary, print bigint, keys array<bigint>, size bigint, odd binary"
    owned = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    sketches = settle(owned.transform(in_batches(_sketch(shingle), schema)))
    same = (F.first(c).alias(c) for c in ("print", "keys", "size", "odd"))
    reps = settle(sketches.groupBy("digest").agg(F.min("doc_id").alias("rep"), *same))
    rows = settle(buckets(reps))
    met = _few(settle(rows.select("rep").distinct()))
    marks = settle(reps.join(met, "rep", "left_semi").select("rep", "print", "size", "odd"))
    links = classes(docs, rows, marks, shingle, least, bucket)
    copies = spread_join(sketches, reps.select("digest", "rep"), ["digest"], "doc_id")
    copies = settle(copies.select("doc_id", "rep").distinct())
    # A document of several texts ties their classes together.
    tied = copies.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    several = copies.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    tied = tied.join(several.withColumnRenamed("doc_id", "a"), "a", "left_semi")
    roots = settle(smallest_reachable(links.unionByName(tied)))
    first = copies.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    found = first.join(roots, first["rep"] == roots["node"], "left")
    return found.select("doc_id", F.coalesce("root", "rep").alias("component_id"))


def drop_similar(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents whose group has a smaller doc_id.

    Of repeated rows with one doc_id and one text one stays; other texts of that doc_id
    stay or go with it. Rows without doc_id stay as they are. All columns are kept.
    """
    gone = settle(groups(docs, **options).filter("component_id < doc_id").select("doc_id"))
    kept = docs.join(_few(gone), "doc_id", "left_anti").select(*docs.columns)
    again = settle(
        docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
        .filter("n > 1").select("doc_id")
    )
    if again.isEmpty():
        return kept
    again = _few(again)
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once).select(*docs.columns)
