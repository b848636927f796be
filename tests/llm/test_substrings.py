from __future__ import annotations

import random
import re

import numpy as np
import pytest

from blockloom.llm import substrings


def brute(rows, window=50):
    split = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), [w for k, w in enumerate(words) if k not in gone]))
    return out


def random_rows(seed, n=40):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    passages = [" ".join(draw.choices(vocabulary, k=draw.choice([49, 50, 51, 70, 130]))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 4)):
            part = draw.choice(passages) if draw.random() < 0.6 else " ".join(draw.choices(vocabulary, k=draw.randint(0, 90)))
            if draw.random() < 0.3 and part:
                words = part.split()
                words[draw.randrange(len(words))] = "edit"
                part = " ".join(words)
            parts.append(part)
        rows.append((i, draw.choice([" ", "\n", "\t \n"]).join(parts)))
    return rows


def check(docs, rows, window=50):
    got = substrings.remove_repeats(docs(rows), window, carry=("lang", "n_words")).collect()
    want = brute(rows, window)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, tuple(r.kept_text.encode().split())) for r in got) == sorted(
        (str(i), n, m, tuple(w.encode() for w in kept)) for i, n, m, kept in want
    )
    texts = dict((str(i), t) for i, t in rows)
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
        if not r.n_removed and len([1 for i, _ in rows if str(i) == str(r.doc_id)]) == 1:
            assert r.kept_text == (texts[str(r.doc_id)] or "")
        assert r.lang == "en"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(spark, docs, seed):
    check(docs, random_rows(seed))


def test_other_window(spark, docs):
    check(docs, random_rows(5), window=5)


def test_edge_cases(spark, docs):
    long = " ".join(f"x{k % 77}é" for k in range(6000))
    same = "The " * 300
    rows = [(5, long), (3, long), (3, long + " more"), (None, long), (9, None), (8, ""), (7, " \n"), (1, same), (2, same + "end"), (6, "few words"), (4, "The " * 49)]
    check(docs, rows)


def test_empty(spark, docs):
    assert substrings.remove_repeats(docs([])).collect() == []


def test_rolling_hash_depends_on_the_window_alone():
    ids = np.arange(1, 40, dtype=np.uint64)
    twice = np.concatenate([np.full(7, 9, np.uint64), ids])
    assert (substrings.rolling(twice, 10, substrings._WINDOWS)[7:] == substrings.rolling(ids, 10, substrings._WINDOWS)).all()
    assert substrings.intervals(np.array([1, 0, 0, 1, 0, 0, 0, 0, 1], bool), 3) == [(0, 6), (8, 11)]
