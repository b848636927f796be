from __future__ import annotations

import time
import re
import random
import zlib

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from blockloom.llm import quality_model, toxicity

LABELS = "doc_id bigint, quality int, toxic int, text string, score double"


def prose(draw, n):
    words = "the old house stood near a river and nobody lived there since winter came with snow".split()
    lines = []
    while n > 0:
        k = min(n, draw.randint(5, 14))
        lines.append(" ".join(draw.choices(words, k=k)).capitalize() + ".")
        n -= k
    return "\n".join(lines)


def junk(draw, n):
    kind = draw.randrange(4)
    words = prose(draw, n).split()
    if kind == 0:
        return " | ".join(words)
    if kind == 1:
        return " ".join(w + draw.choice(["###", "***", "%%%"]) for w in words)
    if kind == 2:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(f"{w} " * 9 for w in words[: n // 9 + 1])


def nasty(draw, n):
    words = prose(draw, n).split(" ")
    for _ in range(draw.randint(1, 4)):
        words.insert(draw.randrange(len(words)), draw.choice(["idiot", "you moron", "1d10t", "scum", "stupiiid"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark, docs):
    draw = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        bad, toxic = k % 6 == 0, k % 6 == 1
        make = junk if bad else nasty if toxic else prose
        rows.append((k, make(draw, draw.randint(20, 200))))
        labels.append((k, int(not bad), int(toxic), "x", 0.5))
    rows += [(1000, None), (1001, ""), (None, "some text without an id"), (1002, " \n"), (7, rows[7][1]), (1003, "word " * 50_000)]
    labels += [(1, None, None, "x", 0.5), (None, 1, 1, "x", 0.5), (2, 0, 0, "x", 0.1), (5000, 1, 1, "x", 0.1)]
    return docs(rows), spark.createDataFrame(labels, LABELS), rows


def check(frame, rows, labelled, want):
    got = frame.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labelled]
    right = sum(want(r) == labelled[r.doc_id] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)


def test_quality(corpus):
    frame, labels, rows = corpus
    labelled = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    labelled[2] = 1
    check(quality_model.quality(frame, labels), rows, labelled, lambda r: int(r.score >= 0.3))


def test_toxicity(corpus):
    frame, labels, rows = corpus
    labelled = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    check(toxicity.toxicity(frame, labels), rows, labelled, lambda r: int(r.score >= 0.5))


@pytest.mark.parametrize("score", [quality_model.quality, toxicity.toxicity])
def test_without_labels_or_documents(spark, docs, corpus, score):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in score(docs([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 1, "x", 0.0)], LABELS)
    assert [round(r.score, 6) for r in score(docs([(1, "a")]), one).collect()] == [round(2 / 3, 6)]
    assert score(docs([]), corpus[1]).collect() == []


def test_moments_give_the_densities_of_the_rows():
    draw = np.random.default_rng(3)
    k = len(quality_model.FEATURES)
    rows = {c: draw.normal(c, 1 + c, (500, k)) for c in (0, 1)}
    model = quality_model.Discriminant({c: (len(x), x.sum(0), x.T @ x) for c, x in rows.items()}, 0.0)
    x = draw.normal(0.5, 1.5, (20, k))
    logs = []
    pooled = (np.var(rows[0], 0) + np.var(rows[1], 0)) / 2
    target = np.diag(pooled + 1e-3 * (rows[0].mean(0) - rows[1].mean(0)) ** 2 + 1e-6)
    for c in (0, 1):
        w = (k + 1) / (k + 501)
        cov = (1 - w) * np.cov(rows[c].T, bias=True) + w * target
        d = x - rows[c].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_disguises():
    for text in ["you 1d10t", "m0ron!", "such an i.d.i.o.t here", "stuuuupid", "i d i o t"]:
        assert toxicity.measure(text)[toxicity.FEATURES.index("disguised")] >= 1, text
    assert toxicity.measure("In 2024, U.S.A. policy e.g. www.example.com 3.14")[5] == 0
    near = toxicity.FEATURES.index("near_second_person")
    assert toxicity.measure("you are an idiot")[near] == 1 and toxicity.measure("an idiot")[near] == 0


def test_beginnings_are_learned(spark):
    draw = random.Random(8)
    rows = []
    for k in range(300):
        words = prose(draw, 40).split()
        if k % 8 == 0:
            words.insert(3, "grulx" + draw.choice(["a", "en", "oso"]))
        rows.append((" ".join(words) + (" onlyonce" if k == 8 else ""), int(k % 8 == 0)))
    frame = spark.createDataFrame(rows + [(None, 0), ("", 1)], "text string, label int")
    # Longer beginnings mark no other words.
    assert [r.begin for r in toxicity.learn_lexicon(frame).collect()] == ["gru"]
    assert toxicity.learn_lexicon(frame.filter("label = 1")) is None
    assert toxicity.measure("a grulxen you", frozenset({"grul"}))[-4:] == [1.0, 1 / 3, 1.0, 1.0]


def test_many_beginnings_are_joined_and_give_the_same(spark, docs):
    rows = [(1, "a grulxen you"), (1, "a grulxen you"), (2, None), (3, ""), (4, "zorf Grulo, you zorf"), (5, "plain")]
    learned = spark.createDataFrame([("gru",), ("zor",), ("zorfi",)], "begin string")
    sent = toxicity.featurise(docs(rows), learned).collect()
    joined = toxicity.featurise(docs(rows), learned, sent=2).collect()
    assert sorted(map(str, sent)) == sorted(map(str, joined)) and len(joined) == len(rows)
    begun = toxicity.FEATURES.index("learned")
    assert sorted((r.doc_id, r.features[begun]) for r in joined) == [(1, 1.0), (1, 1.0), (2, 0.0), (3, 0.0), (4, 3.0), (5, 0.0)]


def test_cloaked_stretches():
    brute = re.compile(
        r"(?<![^\s(\"'])(?=[^\s]*[A-Za-z])(?=[^\s]*[0-9@$!|*._-][A-Za-z])[A-Za-z0-9@$!|*._-]{3,24}(?![^\s),;:?\"'])"
    )
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choice("aB1@.-('\"),;: \n\té€") * draw.choice([1, 1, 1, 9]) for _ in range(draw.randrange(30)))
        assert toxicity._cloaked(text) == [m.group() for m in brute.finditer(text)], text


@pytest.mark.parametrize("unit", ["(", '"', "'a", "'aaa1a", "a1a ", "!", "x"])
def test_measuring_is_linear(unit):
    start = time.perf_counter()
    toxicity.measure(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 8  # quadratic: hours


def test_folded_scores_give_the_same_curve(spark):
    draw = np.random.default_rng(5)
    raw = draw.choice([0.1, 0.2, 0.4, 0.7], 400)
    rows = spark.createDataFrame([(float(x), float(draw.random() < x)) for x in raw], "raw double, label double")
    folded = rows.groupBy("raw").agg(F.avg("label").alias("label"), F.count("label").cast("double").alias("weight"))
    whole = IsotonicRegression(featuresCol="raw").fit(rows)
    curve = IsotonicRegression(featuresCol="raw", weightCol="weight").fit(folded)
    assert np.allclose(curve.predictions.toArray(), whole.predictions.toArray())
    assert np.allclose(curve.boundaries.toArray(), whole.boundaries.toArray())


def test_held_out_recall_and_order_of_toxic_texts(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = toxicity.toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r.score for r in found if r.toxic == 1]
    clean = [r.score for r in found if r.toxic == 0]
    assert sum(x >= 0.5 for x in toxic) >= 0.9 * len(toxic)
    assert sum(x >= 0.5 for x in clean) <= 0.01 * len(clean)
    pairs = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert pairs >= 0.97 * len(toxic) * len(clean)
