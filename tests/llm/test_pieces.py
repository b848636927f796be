from __future__ import annotations

import os
import random
import time

import pytest
import sentencepiece

from blockloom.llm import pieces
from pyspark.sql import functions as F

TEXTS = ["", " ", "a", "Hello world", "  two  blanks ", "line\nline\n\n tab\there", "日本語 text 😀 é", "\x00\x01", "naïve café — déjà vu", "▁ mark", "x" * 300, "aaaa bbbb " * 50, "<s> </s> <unk> <0x0A>"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as file:
        return pieces.Pieces(file.read())


@pytest.fixture(scope="module")
def library():
    with open(pieces.MODEL, "rb") as file:
        return sentencepiece.SentencePieceProcessor(model_proto=file.read())


def slow(vocabulary, text):
    """Best sum over all segmentations, and the ids of the one with the longest last pieces."""
    text = pieces.BLANK + text.replace(" ", pieces.BLANK) if text else ""
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - 48), end):
            if text[start:end] in vocabulary.scores:
                k, score = vocabulary.scores[text[start:end]]
                options.append((best[start] + score, -start, [k]))
        if text[end - 1 : end] not in vocabulary.scores:
            own = [vocabulary.octets[b] for b in text[end - 1].encode()]
            options.append((best[end - 1] + vocabulary.worst, 1 - end, own))
        score, start, ids = max(options, key=lambda o: o[:2])
        best.append(score)
        back.append((-start, ids))
    at, out = len(text), []
    while at:
        at, ids = back[at]
        out[:0] = ids
    return out


def samples():
    draw = random.Random(2)
    letters = "aeinorst  \n.éß▁日"
    return TEXTS + ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(60)]


def test_scores_of_a_unigram_model_are_added_up():
    with open(pieces.MODEL, "rb") as file:
        model = pieces.Pieces(file.read())
    assert model.by_merges
    model.by_merges = False  # the same pieces, their scores taken as log-probabilities
    for text in samples():
        assert model.encode(text) == slow(model, text)


def test_ids_are_the_models_own(vocabulary, library):
    draw = random.Random(6)
    parts = ["  ", "   ", "\n", "a", "the", "ß", "日", "▁", " ", "😀", "é", "1", "\t", "aaaa", "ing", "\r", "Über"]
    mixed = ["".join(draw.choices(parts, k=draw.randint(1, 25))) for _ in range(2000)]
    for text in samples() + mixed:
        assert vocabulary.encode(text) == library.encode(text), text


def test_ids_of_all_documents_are_the_models_own(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pieces.encode(docs, carry=("text",)).collect()
    assert len(got) == docs.count()
    assert [r.doc_id for r in got if r.ids != library.encode(r.text or "")] == []


def test_long_texts_take_time_in_proportion(vocabulary):
    start = time.perf_counter()
    for unit in ("a", "ab", " ", "日", "😀", "\n"):
        text = unit * (200_000 // len(unit))
        assert vocabulary.decode(vocabulary.encode(text)) == text
    assert time.perf_counter() - start < 30


def test_round_trip(vocabulary):
    for text in samples():
        assert vocabulary.decode(vocabulary.encode(text)) == text.replace(pieces.BLANK, " ")


def test_decodes_as_the_library_does(vocabulary, library):
    for text in samples():
        ids = library.encode(text)
        assert vocabulary.decode(ids) == library.decode(ids)


def test_whole_text_gives_the_same_as_words(vocabulary):
    for text in samples():
        whole = pieces.BLANK + text.replace(" ", pieces.BLANK)
        assert list(vocabulary.viterbi(whole) if text else ()) == vocabulary.encode(text)


def test_frames(spark, docs, vocabulary):
    rows = [(1, None), (1, "Hello"), (1, "Hello"), (None, "x"), (2, ""), (3, "long text " * 30_000)]
    encoded = pieces.encode(docs(rows), carry=("lang", "text"))
    back = pieces.decode(encoded, carry=("text", "ids")).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert all(r.ids == vocabulary.encode(r.text or "") for r in back)
    assert pieces.encode(docs([])).collect() == []
    assert os.path.exists(pieces.MODEL) and encoded.select(F.size("ids")).count() == 6


def test_new_short_words_of_many_texts_are_merged_together(vocabulary, library, monkeypatch):
    draw = random.Random(9)
    parts = ["  ", "\n", "a", "the", "ß", "日", "▁", " ", "😀", "1", "\t", "aaaa", "ing", "Über", "\x00", "x" * 70]
    mixed = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(2000)] + TEXTS
    vocabulary.forget()
    monkeypatch.setattr(pieces, "TOGETHER", 100)
    monkeypatch.setattr(pieces, "REMEMBERED", 300)
    for k in range(0, len(mixed), 70):
        some = mixed[k : k + 70]
        assert [ids.tolist() for ids in vocabulary.encode_all(some)] == [library.encode(t) for t in some]
    assert vocabulary.encode_all([]) == []

    def alone(text):
        raise AssertionError(f"{text} was segmented by itself")

    vocabulary.forget()
    monkeypatch.setattr(vocabulary, "viterbi", alone)
    short = ["".join(draw.choices("aeinorst ", k=200)) for _ in range(50)]
    assert [ids.tolist() for ids in vocabulary.encode_all(short)] == [library.encode(t) for t in short]


def test_a_worker_remembers_no_words_after_its_task(vocabulary):
    vocabulary.encode_all(TEXTS)
    vocabulary.encode("a word " + "x" * 300)
    assert vocabulary._memory and vocabulary._pairs
    vocabulary.forget()
    assert not vocabulary._memory and not vocabulary._pairs
