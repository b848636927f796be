from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from blockloom.llm import simhash
from blockloom.llm.components import smallest_reachable


def brute_print(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    grams = [words[k : k + 3] for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    root = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def near(value: int, bits: int, draw: random.Random) -> int:
    for k in draw.sample(range(64), bits):
        value ^= 1 << k
    return value


def some_prints(n: int, seed: int) -> list[int]:
    draw = random.Random(seed)
    made = [draw.getrandbits(64) for _ in range(n // 4)]
    while len(made) < n:
        made.append(near(draw.choice(made), draw.randint(0, 5), draw))
    return sorted(set(made))


@pytest.mark.parametrize("text", ["", "  \n", "One", "One two", "a b c", "É é  x y  z q", "x " * 999])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_links_are_the_links(radius):
    prints = some_prints(500, radius)
    sizes = np.array([200, 60, 20, 1])
    random.Random(1).shuffle(prints)
    prints = np.array(prints[:281], np.uint64)
    found = simhash.linked(prints, sizes, radius)
    begin = 0
    for size in sizes:
        own = {k: int(prints[k]) for k in range(begin, begin + size)}
        want = brute_classes(own, radius)
        edges = [(a, b) for a, b in found if begin <= a < begin + size]
        assert all((own[a] ^ own[b]).bit_count() <= radius for a, b in edges)
        assert len(edges) == size - len(set(want.values()))
        begin += size


@pytest.mark.parametrize("bucket", [2, 10, 2048])
def test_links_at_any_bucket_size(spark, bucket):
    prints = some_prints(120, 7)
    frame = spark.createDataFrame(
        [(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(prints)], "print bigint, rep bigint"
    )
    got = {r.node: r.root for r in smallest_reachable(simhash.links(frame, 3, bucket)).collect()}
    want = brute_classes(dict(enumerate(prints)))
    assert {k: got.get(k, k) for k in want} == want


#: Joins that are planned as sorted ones: turned into a broadcast, or with their tasks split.
ADAPTED = {
    "broadcast": {
        "adaptive.autoBroadcastJoinThreshold": "10m",
        "adaptive.coalescePartitions.enabled": "false",
    },
    "split": {
        "adaptive.autoBroadcastJoinThreshold": "-1",
        "adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "adaptive.advisoryPartitionSizeInBytes": "1k",
    },
}


@pytest.mark.parametrize("adapted", ADAPTED)
def test_adaptive_joins_part_no_bucket(spark, adapted):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(3)]
    prints = sorted({near(draw.choice(base), draw.randint(0, 6), draw) for _ in range(400)})
    settings = {"autoBroadcastJoinThreshold": "-1", **ADAPTED[adapted]}
    settings = {f"spark.sql.{name}": value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = [(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(prints)]
        frame = spark.createDataFrame(rows, "print bigint, rep bigint").repartition(4)
        edges = [tuple(r) for r in simhash.links(frame).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in edges)
    got = dict(enumerate(range(len(prints))))
    for _ in prints:
        for a, b in edges:
            got[a] = got[b] = min(got[a], got[b])
    assert got == brute_classes(dict(enumerate(prints)))


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201)]
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {95: 90, 100: 90, 201: 200}


def test_near_duplicates(spark, docs):
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(9, long), (3, long + " end"), (4, None), (2, ""), (5, " \n"), (7, "Other text here now"), (7, "other TEXT here now"), (None, "own"), (None, long), (8, "Other  text\there now")]
    got = simhash.near_duplicates(docs(rows)).collect()
    prints = {k: brute_print(t) for k, (_, t) in enumerate(rows)}
    classes = brute_classes(prints)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in classes if classes[j] == classes[k] and rows[j][0] is not None]
        want.append((i, prints[k] - (1 << 64) if prints[k] >> 63 else prints[k], min(ids) if ids else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    kept = simhash.drop_near_duplicates(docs(rows))
    assert kept.columns[1:] == docs(rows).columns[1:] or set(kept.columns) == set(docs(rows).columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "2", "7", "7", "None", "None"])


def test_empty(spark, docs):
    assert simhash.near_duplicates(docs([])).collect() == []
