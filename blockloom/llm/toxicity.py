"""A toxicity score: gradient-boosted trees with isotonic calibration.

A text becomes a few dense features: densities of lexicon words, plain and written in
disguise, how near a second person stands to them, capitals, punctuation. The lexicon
has fixed words and, for what they don't cover, other languages above all, beginnings
of words that are far more frequent in toxic texts than in others. These beginnings
and the trees are learned from folds 1 to 3, the isotonic curve from fold 4, whose rows
neither has seen. All is fitted by Spark over all labelled rows of these folds.

All beginnings that pass the thresholds are used, however many. Up to ``SENT_BEGINNINGS``
they go to the tasks as a set; beyond that they stay a table, and each text is joined
with those that it has.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.labels import fold, one_label
from blockloom.llm.shared import in_batches, settle, texts

#: Words of abuse, and words that hurt in company.
ABUSE = frozenset(
    "idiot idiots moron morons loser losers pathetic worthless scum trash clown clowns disgusting "
    "stupid dumb dumbass imbecile cretin jerk asshole bastard bitch vermin filth filthy garbage "
    "retard freak dipshit shit shitty fuck fucking crap bullshit scumbag lowlife parasite "
    "degenerate hideous repulsive braindead".split()
)
HOSTILE = frozenset(
    "hate kill ugly fool liar shut despise useless disgrace shame sick coward pig rot burn choke "
    "nobody fake joke hell damn".split()
)
SECOND = frozenset("you your yours yourself youre u ur du dich dir dein tu te toi vous vos usted tus".split())

FEATURES = (
    "abuse",
    "abuse_density",
    "abuse_kinds",
    "hostile",
    "hostile_density",
    "disguised",
    "near_second_person",
    "second_person",
    "capitals",
    "exclamations",
    "punctuation",
    "obfuscation",
    "words",
    "learned",
    "learned_density",
    "learned_kinds",
    "learned_near_second_person",
)

#: Lengths of the beginnings of words that are learned, and how many are sent to tasks.
BEGINNINGS = (3, 4, 5, 6)
SENT_BEGINNINGS = 100_000
#: A beginning is kept if at least so many toxic texts have it, if it is so many times
#: as frequent in them as in others, and from so high a log-likelihood ratio on.
LEAST_TEXTS, LEAST_RATIO, LEAST_EVIDENCE = 5, 8.0, 25.0
#: Labels are broadcast up to this number of rows.
BROADCAST_ROWS = 500_000

#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|", "oieastasii")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
#: Stretches that may be a disguised word, a letter behind such a sign, and white space.
_STRETCH = re.compile(r"[A-Za-z0-9@$!|*._-]+")
_BEHIND = re.compile(r"[0-9@$!|*._-](?=[A-Za-z])")
_SPACE = re.compile(r"\s")
_SPELT = re.compile(r"(?<!\w)(?:[A-Za-z][ .\-_*]){2,15}[A-Za-z](?!\w)")
_TRIPLE = re.compile(r"(.)\1{2,}")


def _reveal(token: str) -> str:
    plain = token.lower().strip(".!-_*").translate(DISGUISE)
    return re.sub(r"[^a-z]", "", plain)


def _cloaked(text: str) -> list[str]:
    """Stretches of 3 to 24 letters, digits and signs that stand alone, if they, or what
    follows up to the next white space, have a letter behind a digit or sign."""
    behind = [m.start() for m in _BEHIND.finditer(text)]
    if not behind:
        return []
    spaces = [m.start() for m in _SPACE.finditer(text)] + [len(text)]
    found = []
    for m in _STRETCH.finditer(text):
        begin, end = m.span()
        if not 3 <= end - begin <= 24:
            continue
        before, after = text[begin - 1 : begin], text[end : end + 1]
        if before not in "(\"'" and not before.isspace():
            continue
        if after not in "),;:?\"'" and not after.isspace():
            continue
        at = bisect_left(behind, begin)
        if at < len(behind) and behind[at] < spaces[bisect_left(spaces, begin)]:
            found.append(m.group())
    return found


def _disguised(text: str, words: list[str]) -> tuple[int, int]:
    """Lexicon words in disguise, and tokens that look disguised."""
    tokens = _cloaked(text) + [m.group() for m in _SPELT.finditer(text)]
    found = sum(1 for t in tokens if _reveal(t) in ABUSE and t.lower() not in ABUSE)
    for word in words:
        if _TRIPLE.search(word):
            tokens.append(word)
            found += _TRIPLE.sub(r"\1", word) in ABUSE or _TRIPLE.sub(r"\1\1", word) in ABUSE
    return found, len(tokens)


def measure(text: str, learned: frozenset[str] = frozenset()) -> list[float]:
    """The features of a text, all zero if it has no words."""
    words = [w.lower() for w in _WORD.findall(text)]
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    at = [k for k, w in enumerate(words) if w in ABUSE]
    hostile = sum(1 for w in words if w in HOSTILE)
    second = [k for k, w in enumerate(words) if w in SECOND]
    own = set(second)

    def beside(places: list[int]) -> int:
        if not own:
            return 0
        return sum(1 for k in places if any(j in own for j in range(k - 5, k + 6)))

    begun = [k for k, w in enumerate(words) if any(w[:i] in learned for i in BEGINNINGS)] if learned else []
    disguised, cloaked = _disguised(text, words)
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, bytes(range(65, 91))))
    marks = len(raw) - len(raw.translate(None, b"!?.,;:\"'()-"))
    shouts = raw.count(b"!")
    return [
        float(len(at)),
        len(at) / n,
        float(len({words[k] for k in at})),
        float(hostile),
        hostile / n,
        float(disguised),
        float(beside(at)),
        len(second) / n,
        upper / len(raw),
        shouts / n,
        marks / len(raw),
        cloaked / n,
        math.log1p(n),
        float(len(begun)),
        len(begun) / n,
        float(len({words[k] for k in begun})),
        float(beside(begun)),
    ]


def _beginnings(text: Column) -> Column:
    """The different beginnings of the words of a text, of all lengths that are learned."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{Nd}]+"))
    return F.array_distinct(
        F.flatten(
            F.transform(
                F.filter(words, lambda w: F.char_length(w) >= min(BEGINNINGS)),
                lambda w: F.array(*(F.substring(w, F.lit(1), F.lit(i)) for i in BEGINNINGS)),
            )
        )
    )


def learn_lexicon(texts_: DataFrame) -> DataFrame | None:
    """Beginnings of words that mark toxic texts (``begin``), from a frame with text and
    label; None if a class is missing.

    Counted over all rows given. A beginning that a shorter one implies is left out: it
    would mark no more words.
    """
    rows = texts_.groupBy("label").count().collect()
    totals = {r["label"]: r["count"] for r in rows}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return None
    counted = (
        texts_.select("label", F.explode(_beginnings(F.col("text"))).alias("begin"))
        .groupBy("begin")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
        .filter(F.col("t") >= LEAST_TEXTS)
    )
    share = toxic / (toxic + clean)
    n = F.col("t") + F.col("c")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    evidence = 2 * (part(F.col("t"), n * share) + part(F.col("c"), n * (1 - share)))
    ratio = (F.col("t") / toxic) / ((F.col("c") + 0.5) / clean)
    kept = settle(
        counted.filter((ratio >= LEAST_RATIO) & (evidence >= LEAST_EVIDENCE)).select("begin")
    )
    shorter = F.array(*(F.substring("begin", 1, i) for i in BEGINNINGS[:-1]))
    implied = (
        kept.select("begin", F.explode(shorter).alias("short"))
        .filter("short <> begin")
        .join(kept.select(F.col("begin").alias("short")), "short", "left_semi")
    )
    return kept.join(implied.select("begin"), "begin", "left_anti")


def marked(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """doc_id, text and marks, the learned beginnings that a text has.

    Rows are numbered, so that repeated ones stay apart; only beginnings that are learned
    are gathered again.
    """
    rows = settle(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
    held = (
        rows.select("_row", F.explode(_beginnings(F.col("text"))).alias("begin"))
        .join(learned, "begin")
        .groupBy("_row")
        .agg(F.collect_list("begin").alias("marks"))
    )
    return rows.join(held, "_row", "left").drop("_row")


def featurise(
    docs: DataFrame, learned: DataFrame | None = None, sent: int = SENT_BEGINNINGS
) -> DataFrame:
    """doc_id and features, an array of doubles, of every row.

    ``learned`` are beginnings of words (``begin``). Up to ``sent`` of them the driver
    sends to the tasks; more are joined with the texts that have them.
    """
    known: frozenset[str] = frozenset()
    rows = docs.select("doc_id", "text")
    if learned is not None:
        first = learned.limit(sent + 1).collect()
        if len(first) <= sent:
            known = frozenset(r["begin"] for r in first)
        else:
            rows = marked(docs, learned)
    joined = "marks" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks").to_pylist() if joined else [None] * batch.num_rows
            made = [
                measure(t.decode(), frozenset(own or ()) if joined else known)
                for t, own in zip(texts(batch), marks)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "features"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.transform(in_batches(run, f"doc_id {kind}, features array<double>"))


def toxicity(
    docs: DataFrame, labels: DataFrame, trees: int = 15, depth: int = 3, seed: int = 42
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out and score, from 0 to 1.

    The score is the calibrated probability of ``labels.toxic`` = 1. Fold 0 is held
    out; labels, and columns other than the text, are never features. Where the
    folds to learn from lack a class, all rows get the share of class 1, one more row
    of either class assumed; where only the calibration fold does, scores are the
    trees' own. NULL, empty and blank texts have zeros for features. Of several
    labels of a document the greatest counts; NULL ones and those of no document are
    ignored. Repeated rows are all learned from and returned; other columns are
    dropped.
    """
    labelled = one_label(labels, "toxic").filter("label IN (0, 1)")
    early = labelled.filter(fold("doc_id").isin(1, 2, 3))
    if early.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        early = F.broadcast(early)
    learned = learn_lexicon(docs.select("doc_id", "text").join(early, "doc_id"))
    rows = settle(featurise(docs, learned))
    known = settle(
        rows.withColumn("fold", fold("doc_id"))
        .filter("fold <> 0")
        .join(labelled, "doc_id")
        .select("fold", F.col("label").cast("double"), array_to_vector("features").alias("features"))
    )
    counts = {
        (r["late"], int(r["label"])): r["count"]
        for r in known.groupBy((F.col("fold") == 4).alias("late"), "label").count().collect()
    }
    early = [counts.get((False, c), 0) for c in (0, 1)]
    out = rows.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "features")
    if min(early) == 0:
        ones = early[1] + counts.get((True, 1), 0)
        share = (ones + 1) / (sum(counts.values()) + 2)
        return out.select("doc_id", "held_out", F.lit(float(share)).alias("score"))
    boosted = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed
    ).fit(known.filter("fold <> 4"))

    def probability(frame: DataFrame) -> DataFrame:
        scored = boosted.transform(frame)
        return scored.withColumn("raw", vector_to_array("probability")[1])

    scored = probability(out.withColumn("features", array_to_vector("features")))
    if min(counts.get((True, c), 0) for c in (0, 1)) == 0:
        return scored.select("doc_id", "held_out", F.col("raw").alias("score"))
    # Few trees give few different scores: rows of one score become one, with their number.
    scores = probability(known.filter("fold = 4")).groupBy("raw")
    scores = scores.agg(F.avg("label").alias("label"), F.count("label").cast("double").alias("weight"))
    curve = IsotonicRegression(
        featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="score"
    ).fit(scores)
    return curve.transform(scored.select("doc_id", "held_out", "raw")).select(
        "doc_id", "held_out", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score")
    )
