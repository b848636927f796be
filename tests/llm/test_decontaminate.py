from __future__ import annotations

import random
import re

import pytest

from blockloom.llm import decontaminate

ITEMS = "item_id bigint, text string, doc_id string, key int"


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(rows, items, window=13):
    windows = {}
    for i, text in items:
        w = split(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for i, text in rows:
        w = split(text)
        hit, ids = set(), set()
        for key, own in windows.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k : k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    ids |= own
        out.append((str(i), len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def result(frame):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in frame.collect()
    )


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_against_brute_force(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(25)] + ["Été", "été", "X1"]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([2, 5, 12, 13, 14, 40])))) for k in range(12)]
    items += [(99, items[4][1]), (None, "only this one"), (50, ""), (51, None), (52, "a a a a a a a a a a a a a a a")]
    rows = [(None, "Only, this-one! and more"), (1, None), (2, ""), (3, "..."), (4, "a " * 30), (4, "only this one"), (5, items[8][1].upper())]
    for k in range(6, 40):
        parts = []
        for _ in range(draw.randint(1, 4)):
            text = draw.choice(items)[1] or ""
            w = text.split()
            cut = draw.randint(0, 3)
            parts.append(" ".join(draw.choices(vocabulary, k=draw.randint(0, 60))))
            parts.append(", ".join(w[cut:]) if draw.random() < 0.8 else text)
        rows.append((k, " ".join(parts)))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    got = decontaminate.contamination(docs(rows), frame, carry=("text", "n_words", "lang"))
    assert result(got) == brute(rows, items)
    assert sorted(str(r.text) for r in got.collect()) == sorted(str(t) for _, t in rows)


def test_near(spark, docs):
    w = [f"w{k}" for k in range(30)]
    changed = [x if k not in (7, 9) else "other" for k, x in enumerate(w[:13])]
    frame = spark.createDataFrame([(1, " ".join(w), "x", 1)], ITEMS)
    rows = [(1, " ".join(changed)), (2, " ".join(["zz"] + w[2:15]))]
    got = {r.doc_id: r for r in decontaminate.occurrences(docs(rows), frame).collect()}
    assert [(m.shift, m.phrase_starts, m.near_starts) for m in got[1].matches] == [(0, [], [0, 1])]
    assert got[2].matches[0].phrase_starts == [1]


def test_empty(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", "x", 1)], ITEMS)
    assert decontaminate.contamination(docs([]), some).collect() == []
    assert result(decontaminate.contamination(docs([(1, "a b c")]), none)) == [("1", 3, 0, (), False)]
