"""Token counts of prefixes against the library's, prefix by prefix."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from blockloom.llm import queries, token_counts
from blockloom.llm.token_counts import MODEL, Merges, prefix_within, tokens_before

tokenizers = pytest.importorskip("tokenizers")

PARTS = [
    "<|endoftext|>", "  ", "\n\n", "   \n  ", "'re", "'ve", "'s", "'ll", "'", " ", "\t", "été", "日本", "😀", " ",
    "　x", "՘", "123", "a" * 20, "-" * 40, "don't", "\x1c", "\x85", "<|", "|>", "the", " house", "Über", "\r\n",
]


@pytest.fixture(scope="module")
def merges():
    with open(MODEL, encoding="utf-8") as file:
        return Merges(file.read())


@pytest.fixture(scope="module")
def count():
    library = tokenizers.Tokenizer.from_file(MODEL)
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(20))
def test_every_prefix(merges, count, seed):
    rng = random.Random(seed)
    for _ in range(30):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(10)))
        want = [count(text[:k]) for k in range(len(text) + 1)]
        assert merges.prefix_counts(text).tolist() == want
        assert merges.prefix_counts(text, exact=False)[-1] == want[-1]


def test_other_vocabularies_are_refused():
    with open(MODEL.replace("byte_bpe_50k", "word_bpe_49k"), encoding="utf-8") as file:
        with pytest.raises(ValueError):
            Merges(file.read())


def test_look_ups(spark, docs, count):
    text = "Some words, and  more: \n\n don't  stop<|endoftext|> until the end"
    rows = [(1, text), (2, None), (3, ""), (4, "ab"), (4, "ab")]
    made = token_counts.prefix_counts(docs(rows), carry=("text", "lang"))
    assert made.columns == ["doc_id", "text", "lang", "counts"]
    got = made.select(
        "doc_id",
        F.size("counts").alias("size"),
        tokens_before("counts", 20).alias("before"),
        tokens_before("counts", -1).alias("nothing"),
        prefix_within("counts", 9).alias("chars"),
        prefix_within("counts", 0).alias("none"),
    ).collect()
    want = []
    for i, t in rows:
        t = t or ""
        chars = max(k for k in range(len(t) + 1) if count(t[:k]) <= 9)
        want.append((i, len(t) + 1, count(t[:20]), 0, chars, 0))
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_counts.prefix_counts(docs([])).collect() == []


def test_nulls_long_texts_and_repeats(spark, docs, count):
    rows = [(1, None), (2, ""), (3, " " * 70_000 + "x"), (4, "é" * 50_000), (None, "a b"), (5, "x"), (5, "x")]
    got = token_counts.token_counts(docs(rows)).collect()
    want = [(i, len((t or "").encode()), count(t or "")) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(docs([])).collect() == []


def test_query_gives_the_librarys_counts(spark, count):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op12_token_counts(spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(documents)
    for doc in documents:
        n = count(doc.text or "")
        assert got[doc.doc_id] == (len((doc.text or "").encode()), n, n > 512)
