from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from blockloom.llm import similar

BLANKS = "\t\n\x0b\x0c\r"


def shingles(text: str | None, size: int = 5) -> frozenset[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in BLANKS:
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    return frozenset(" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def alike(a: frozenset, b: frozenset, least: float = 0.8) -> bool:
    return a == b or len(a & b) >= least * len(a | b)


def brute_pairs(sets: dict[int, frozenset]) -> set[tuple[int, int]]:
    """All pairs of different sets with a similarity of 0.8 or more, one id for each set."""
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    held = defaultdict(list)
    for grams, i in first.items():
        for gram in grams:
            held[gram].append(i)
    own, pairs = {i: grams for grams, i in first.items()}, set()
    for i, grams in own.items():
        common = Counter(j for gram in grams for j in held[gram] if j > i)
        pairs |= {(i, j) for j, n in common.items() if n >= 0.8 * (len(grams) + len(own[j]) - n)}
    return pairs


def brute_groups(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in texts.items()}
    root, first = {}, {}
    for i in sorted(sets):
        root[i] = first.setdefault(sets[i], i)
    changed, pairs = True, brute_pairs(sets)
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        for i in root:
            root[i] = root[root[i]]
    return root


def changed(words: list[str], n: int, draw: random.Random) -> list[str]:
    made = list(words)
    for k in draw.sample(range(len(made)), n):
        made[k] = f"new{draw.random()}"
    return made


def family(n: int, words: int, edits: int, seed: int) -> dict[int, str]:
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(words)]
    return {k: " ".join(changed(base, draw.randint(0, edits), draw)) for k in range(n)}


@pytest.mark.parametrize("bucket", [3, 8192])
def test_groups_are_those_of_all_pairs(spark, docs, bucket):
    texts = {}
    for number in range(12):
        for k, text in family(12, 120, 3, number).items():
            texts[100 * number + k] = text
    for number in range(40):
        texts[5000 + number] = " ".join(f"x{number * 50 + k}" for k in range(60))
    texts |= {6000 + k: texts[k * 100] for k in range(12)}
    got = {r.doc_id: r.component_id for r in similar.groups(docs(list(texts.items())), bucket=bucket).collect()}
    want = brute_groups(texts)
    assert set(got) == set(texts) and all(alike(shingles(texts[i]), shingles(texts[i])) for i in got)
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    assert all(want[got[i]] == want[i] for i in got)  # nothing is linked that shouldn't be


@pytest.mark.parametrize("bucket", [3, 8192])
def test_one_large_group_of_different_texts(spark, docs, bucket):
    texts = family(300, 200, 2, 5)
    got = {r.doc_id: r.component_id for r in similar.groups(docs(list(texts.items())), bucket=bucket).collect()}
    assert got == brute_groups(texts) and set(got.values()) == {0}


def test_links_are_checked(spark, docs):
    """Texts with a common half are in common buckets, but no near copies."""
    half = " ".join(f"h{k}" for k in range(200))
    texts = {k: half + " " + " ".join(f"own{k}.{j}" for j in range(80)) for k in range(30)}
    got = {r.doc_id: r.component_id for r in similar.groups(docs(list(texts.items()))).collect()}
    assert got == {k: k for k in texts}


def test_the_limit_belongs_to_the_links(spark, docs):
    # Nine shingles; one more word makes ten, one fewer than the last eight of them.
    words = [f"w{k}" for k in range(12)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "w12", "w13"])), (3, " ".join([*words, "a", "b", "c"]))]
    pairs = brute_pairs({i: shingles(t) for i, t in rows})
    assert pairs == {(1, 2)}  # 8 of 10; 8 of 11 is less
    links = spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint")
    assert [tuple(r) for r in similar.checked(docs(rows), links, 5, 0.8).collect()] == [(1, 2)]


def test_odd_rows(spark, docs):
    long = " ".join(f"w{k}" for k in range(300_000))
    rows = [
        (4, None), (2, ""), (5, " \n"), (9, long), (3, long + " end"), (7, "Few words"), (8, "few\tWORDS"),
        (7, "Few words"), (11, "one two three"), (11, "another text of that document"), (None, "Few words"),
        (12, "another text of that document"), (None, None),
    ]
    got = {r.doc_id: r.component_id for r in similar.groups(docs(rows)).collect()}
    assert got == {4: 2, 2: 2, 5: 2, 9: 3, 3: 3, 7: 7, 8: 7, 11: 11, 12: 11}
    kept = similar.drop_similar(docs(rows))
    assert kept.columns == docs(rows).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["2", "3", "7", "11", "11", "None", "None"])


def test_a_document_of_two_texts_ties_their_groups(spark, docs):
    rows = [(1, "first text it is"), (5, "second text it is"), (5, "first text it is"), (6, "second text it is")]
    got = {r.doc_id: r.component_id for r in similar.groups(docs(rows)).collect()}
    assert got == {1: 1, 5: 1, 6: 1}


def one_key_pair(seed: int) -> tuple[str, str]:
    """Two texts that are similar enough and share one key alone."""
    draw = random.Random(seed)
    while True:
        words = [f"w{draw.randrange(10**6)}" for _ in range(180)]
        pair = " ".join(words), " ".join(changed(words, 3, draw))
        keys = [similar.band_keys(np.unique(similar.shingle_hashes(t.encode(), 5))) for t in pair]
        if sum(a == b for a, b in zip(*keys)) == 1 and alike(*map(shingles, pair)):
            return pair


@pytest.mark.parametrize("bucket", [1, 2])
def test_large_buckets_lose_no_partner(spark, docs, bucket):
    """Texts that share one key are compared however many have that key."""
    texts = {}
    for number in range(4):
        a, b = one_key_pair(number)
        texts |= {10 * number: a, 10 * number + 1: b, 10 * number + 2: b + " more", 10 * number + 3: a + " more"}
    got = {r.doc_id: r.component_id for r in similar.groups(docs(list(texts.items())), bucket=bucket).collect()}
    assert got == {i: i // 10 * 10 for i in texts}


def test_two_parts_hold_any_two_classes(spark):
    draw = random.Random(3)
    classes = {rep: 0 if rep < 60 else rep // 3 for rep in range(100)}
    rows = [(m, 7, draw.randrange(99), rep, c) for m in (0, 1) for rep, c in classes.items()]
    frame = spark.createDataFrame(rows, "mask bigint, key bigint, print bigint, rep bigint, component bigint")
    held = defaultdict(set)
    for r in similar.paired(frame, 16).collect():
        held[r.mask, r.key].add(r.rep)
    assert max(map(len, held.values())) < 50  # parts of about 8, dealt by hash
    for m in (0, 1):
        met = {(a, b) for (mask, _), reps in held.items() if mask == m for a in reps for b in reps}
        assert all((a, b) in met for a in classes for b in classes if classes[a] != classes[b])


def test_empty(spark, docs):
    assert similar.groups(docs([])).collect() == []
    assert similar.drop_similar(docs([])).collect() == []


def test_keys():
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 10_000, np.uint64))
    keys = similar.band_keys(hashes)
    assert len(keys) == similar.BANDS and similar.band_keys(hashes[:0]) == []
    assert keys == similar.band_keys(np.unique(np.concatenate([hashes, hashes[:5]])))


def test_recall_over_all_pairs(spark):
    """Every pair of the given documents that is similar enough, by an index of all shingles."""
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    pairs = brute_pairs(sets)
    got = {r.doc_id: r.component_id for r in similar.groups(frame).collect()}
    want = brute_groups(texts)
    caught = sum(got[a] == got[b] for a, b in pairs)
    print(len(pairs), "pairs,", caught, "found")
    assert len(pairs) > 20 and caught >= 0.95 * len(pairs)
    assert all(want[got[i]] == want[i] for i in got)


def one_family(n: int, edits: int, seed: int, words: int = 400) -> dict[int, str]:
    """Texts of one beginning text, each with that many words of its own."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    return {k: " ".join(changed(base, edits, draw)) for k in range(n)}


def bucket_of(texts: dict[int, str]) -> tuple[pa.Table, np.ndarray]:
    """All texts as one bucket, each a class of its own."""
    sets = {i: np.unique(similar.shingle_hashes(t.encode(), 5)) for i, t in texts.items()}
    prints = np.array([similar.majority(h) for h in sets.values()], np.uint64).view(np.int64)
    rows = pa.table({
        "mask": [0] * len(sets), "key": [0] * len(sets), "print": prints, "rep": list(sets), "component": list(sets),
        "size": [len(h) for h in sets.values()], "odd": [similar.parities(h) for h in sets.values()],
    })
    return rows, np.array([len(sets)])


def test_no_possible_link_is_ruled_out():
    draw = random.Random(8)
    texts = [t for words in (8, 60, 90, 400, 3000, 9000) for k in range(6)
             for t in one_family(4, draw.randrange(1 + words // 20), 100 * words + k, words).values()]
    texts += [t + " and" * draw.randrange(400) + " more" for t in texts[::3]]
    sets = [np.unique(similar.shingle_hashes(t.encode(), 5)) for t in texts]
    apart = similar.Apart(np.array([len(h) for h in sets]), [similar.parities(h) for h in sets])
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    can = apart.possible(a, b, 0.8)
    common = np.array([len(np.intersect1d(sets[x], sets[y], True)) for x, y in zip(a, b)])
    either = apart.sizes[a] + apart.sizes[b] - common
    assert can[common >= 0.8 * either - 1e-9].all() and np.sum(common >= 0.8 * either) > 2 * len(sets)
    assert not can[common < 0.6 * either].any()


@pytest.mark.parametrize("number", [2, 32, 512, None])
def test_unlike_texts_of_one_bucket_give_no_links(number):
    """Their fingerprints are near, and each pair was a link to be checked."""
    rows, sizes = bucket_of(one_family(60, 26, 4))
    assert all(not alike(*map(shingles, pair)) for pair in zip(*[iter(one_family(60, 26, 4).values())] * 2))
    prints = rows["print"].to_numpy().view(np.uint64)
    assert sum(len(a) for a, _ in similar.near_pairs(prints, sizes, similar.RADII[-1])) > 1500
    assert sum(map(len, similar._forests(number, similar.RADII, 0.8)(rows, sizes))) < 60


def test_rounds_end_with_all_links():
    rows, sizes = bucket_of(one_family(40, 3, 6))
    few, some, every = (
        np.concatenate(list(similar._forests(number, similar.RADII, 0.8)(rows, sizes))) for number in (2, 32, None)
    )
    assert len({tuple(p) for p in every.tolist()}) == len(every) == 40 * 39 // 2
    told = few[:, 0] == few[:, 1]
    assert told.sum() == 1 and len(few) - 1 == 2 * 39
    assert not (some[:, 0] == some[:, 1]).any() and {tuple(p) for p in some.tolist()} == {tuple(p) for p in every.tolist()}
