"""A corpus pipeline: each stage's documents are the next one's input.

For every stage: a NULL text is an empty one, a text is taken whole however long it is, an
empty table gives an empty one, and columns other than those of documents are dropped
whatever their names. Rows are told apart by doc_id; what repeated rows, ties and rows
without doc_id give is said with each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import decontaminate, pieces, quality_rules, similar, substrings
from blockloom.llm.shared import read, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = ("lang", "source", "n_chars")


def _documents(found: DataFrame, text: str, changed: Column) -> DataFrame:
    """The columns of documents; n_chars is counted anew where the text has changed."""
    chars = F.when(changed, F.char_length(text).cast("bigint")).otherwise(F.col("n_chars"))
    return found.select("doc_id", F.col(text).alias("text"), "lang", "source", chars.alias("n_chars"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules stay, without their failing lines.

    Each row is judged by itself: repeated rows, and rows without doc_id, stay or go like any
    other. NULL and empty texts go, having fewer than 20 words.
    """
    judged = quality_rules.judge(docs, carry=REST).filter("kept")
    return _documents(judged, "cleaned_text", F.col("lost") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id, stays.

    Near copies have a Jaccard similarity of 0.8 or more of five-word shingles. NULL and
    empty texts form one group. Of repeated rows with one doc_id and text one stays; other
    texts of that doc_id stay or go with it. Rows without doc_id stay.
    """
    return similar.drop_similar(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a smaller document has are cut out.

    Repeated rows with one doc_id are one document, which cuts nothing from itself; NULL
    and empty texts have nothing to cut.
    """
    cut = substrings.remove_repeats(docs, carry=REST)
    return _documents(cut, "kept_text", F.col("n_removed") > 0)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages contaminate go.

    Each row is judged by itself, repeated or not; NULL and empty texts stay.
    """
    found = decontaminate.contamination(
        docs, read(spark, sf_dir, "benchmark"), carry=("text", *REST)
    )
    return found.filter("NOT contaminated").select(*COLUMNS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, beside the text that they decode to.

    Every row is returned, repeated or not; NULL and empty texts have no pieces.
    """
    encoded = pieces.encode(docs, carry=REST)
    return pieces.decode(encoded, carry=("ids", *REST)).select(
        "doc_id",
        F.col("decoded").alias("text"),
        *REST,
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", clean),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_free),
    ("sentencepiece", to_pieces),
]

#: Fingerprints and pieces can't be computed in SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
