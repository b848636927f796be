"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import (
    chat,
    decontaminate,
    html,
    licenses,
    merkle,
    oracles,
    pieces,
    quality_model,
    quality_rules,
    runs,
    simhash,
    substrings,
    token_counts,
    toxicity,
)
from blockloom.llm.shared import BLANK, read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    groups = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and one of control strings; digests of what is read back."""
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(turns.unionByName(hard))
    back = formatted.select(
        "conv_id",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat a passage of a document with a smaller id, and what is left."""
    cut = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    kept = F.trim(F.regexp_replace("kept_text", f"{BLANK}+", " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of the labels is held out."""
    scored = quality_model.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document, and whether it is kept after its lines are cleaned."""
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    text = html.extract(read(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, taken as a file of a tree.

    Documents lie in source/lang/thousand; every tenth is a licence file, a level up.
    """
    place = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("_"))
    shelf = F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("_"))
    path = F.when(F.col("doc_id") % 10 == 0, F.concat_ws("/", place, F.concat(F.lit("LICENSE-"), number)))
    path = path.otherwise(F.concat_ws("/", place, shelf, F.concat(number, F.lit(".txt"))))
    files = read(spark, sf_dir, "documents").select(path.alias("path"), "text")
    return licenses.scan(files)


def op7_licenses_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document in a tree whose licence files lie beside, and above, other files.

    Documents lie in source/lang/thousand. A hash of doc_id makes every fourth a licence
    file, and deals these to the three levels of directories.
    """
    parts = [
        F.coalesce("source", F.lit("_")),
        F.coalesce("lang", F.lit("_")),
        F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("_")),
    ]
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("_"))
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(12))
    path = F.concat_ws("/", *parts, F.concat(number, F.lit(".txt")))
    for depth in range(1, 4):
        named = F.concat_ws("/", *parts[:depth], F.concat(F.lit("LICENSE-"), number))
        path = F.when(dealt == depth - 1, named).otherwise(path)
    files = read(spark, sf_dir, "documents").select(path.alias("path"), "text")
    return licenses.scan(files)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and a digest of the text decoded from them."""
    encoded = pieces.encode(read(spark, sf_dir, "documents"))
    return pieces.decode(encoded, carry=("ids",)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
        F.char_length("decoded").cast("bigint").alias("decoded_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the labels is held out."""
    scored = toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by a checksum of its id, goes on repeating some of its words."""
    n = len(words)
    checksum = zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or checksum % 10:
        return words
    chosen = checksum // 10
    begin = chosen % n
    period = 1 + (n - begin) // (3 + chosen % 8)
    unit = words[begin : begin + period]
    return (words[:begin] + unit * -(-(n - begin) // period))[:n]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, the longest of them, and what is left."""
    found = runs.periodic_runs(read(spark, sf_dir, "documents"), alter=_with_repeats)
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and whether its proof holds."""
    return merkle.manifest(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_chat": op2_chat,
        "op3_substrings": op3_substrings,
        "op4_quality_model": op4_quality_model,
        "op5_quality_rules": op5_quality_rules,
        "op6_html": op6_html,
        "op7_licenses": op7_licenses,
        "op7_licenses_tree": op7_licenses_tree,
        "op8_decontaminate": op8_decontaminate,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_toxicity": op10_toxicity,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_token_counts": op12_token_counts,
        "op13_manifest": op13_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
