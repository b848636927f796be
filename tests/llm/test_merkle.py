"""The manifest against one built and climbed in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from blockloom.llm import merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climbed(level, k, folded):
    siblings = []
    while len(level) > 1:
        first, place = k // 8 * 8, k % 8
        run = level[first : first + 8]
        siblings += run[:place] + run[place + 1 :]
        folded = digest("".join(run[:place] + [folded] + run[place + 1 :]))
        level, k = [digest("".join(level[i : i + 8])) for i in range(0, len(level), 8)], k // 8
    return siblings, folded, level[0]


def brute(rows):
    shelves = {}
    for row in rows:
        shelves.setdefault(row[2], []).append(row)
    names = sorted(shelves, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in names:
        shelves[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    hashes = {lang: [leaf(r) for r in shelves[lang]] for lang in names}
    tops = [climbed(hashes[lang], 0, "")[2] for lang in names]
    found = []
    for number, lang in enumerate(names):
        for k, row in enumerate(shelves[lang]):
            start = hashes[lang][k]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                start = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            below, folded, subroot = climbed(hashes[lang], k, start)
            above, folded, root = climbed(tops, number, folded)
            proof = digest("".join(below + above))
            found.append((row[0], hashes[lang][k], subroot, root, proof, folded, folded == root))
    return found


def some(n):
    rng = random.Random(n)
    return [
        (
            rng.choice([i, i, i, None]),
            rng.choice([None, "x", ""]),
            rng.choice(["de", "en", "en", "en", "é", "Z", None]),
            rng.choice([None, i]),
            rng.choice([None, "", "AbÉ", "plain", "Ab"]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(7, None, None, None, None)],
        [(i, "s", "en", 3, "Abc") for i in range(9)],
        some(700) + [(3, "a", "en", 1, "T")] * 100,
        [(i, "s", f"lang{i % 90}", 1, "Ab") for i in range(300)],
        [(1, "s", "en", 10**6, "Long " * 200_000), (2, "s", "en", 1, "x")],
    ],
)
def test_manifest(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("leaf", "tree", "idx", "hash", "copy", "n"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    got = merkle.manifest(docs)
    assert got.columns == list(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_settings_are_put_back(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "17")
    try:
        merkle.manifest(spark.createDataFrame(some(40), DOCS)).collect()
        assert spark.conf.get(name) == "17"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
