"""Runs of words against comparing every pair of neighbours at every distance."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from blockloom.llm import queries, runs


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        j = 0
        while j + q < n:
            start = j
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - start >= max(6, 4 * q):
                found.setdefault((start, j + q), q)
            j += j == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(rng):
    alphabet = [f"w{k}" for k in range(rng.choice([1, 2, 3, 50]))]
    words = [rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 30, 200, 500]))]
    for _ in range(rng.choice([0, 1, 3])):
        period = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40, 64])
        unit = [rng.choice(alphabet + ["x", "y"]) for _ in range(period)]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 9)[: rng.choice([4 * period - 1, 4 * period, 5 * period + 1, 7 * period])]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_many_texts(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(rng.choice([1, 3, 20]))]
    assert runs.runs_of(texts) == [brute(words) for words in texts]


def test_scales_and_long_periods():
    rng = random.Random(7)
    unit = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    assert runs.runs_of([unit * 4 + unit[:5], unit * 3]) == [[(0, 12005, 3000)], []]
    assert runs.runs_of([["a"] * 200_000]) == [[(0, 200_000, 1)]]
    inner = ["a", "b"] * 10 + ["c"]  # a run of runs
    assert runs.runs_of([inner * 5]) == [brute(inner * 5)]


def test_nulls_ties_repeats_and_clashing_columns(spark, docs):
    two = "a a a a a a b c c c c c c"
    long = " ".join(f"w{k % 11}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, two), (4, two), (None, "x x x x x x"), (5, "a a a a a"), (6, long)]
    got = runs.periodic_runs(docs(rows)).collect()
    want = []
    for i, text in rows:
        words = (text or "").split()
        found = brute(words) if len(words) < 100 else [(0, 20_000, 11)]
        want.append((i, len(words), found, brute_collapsed(words, found)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(want, key=key)
    assert runs.periodic_runs(docs([])).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(documents)
    some = 0
    for doc in documents:
        words = [w for w in (doc.text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = brute(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[doc.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (best[1] and 1000 * best[1] // best[2])
        lines = "".join("%d,%d,%d\n" % x for x in found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest()
        some += bool(found)
    assert some > 5
