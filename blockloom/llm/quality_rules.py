"""Line-first cleaning of documents. DataFrame functions only.

Every line is judged by itself and failing lines are removed; a document that loses
too much of its text that way, or fails the base rules, is rejected as a whole.
Everything happens inside a row, so nothing is shuffled.

A line fails if it is, in words between white space,

* navigation: three or more separators such as | or ›, one for every four words
  at least;
* symbols: over a tenth of its characters, white space apart, are marks of markup;
* shouting: more than six tenths of its letters are capitals, and two or more words
  end in an exclamation mark;
* stutter: of eight or more words, three tenths repeat the word before them;
* unpunctuated: twelve or more words without any mark that ends a sentence or clause;
* boilerplate: at most 25 words and a phrase of ``BOILERPLATE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.shared import BLANK, blank_split, computed

#: Documents of fewer words fail the base rules.
LEAST_WORDS = 20
#: So do those with more per cent of their words in repeated windows.
MOST_REPEATED = 30
WINDOW = 8
#: Documents that lose a larger share of their words' characters are rejected.
MOST_LOST = 0.4

SYMBOLS = "#*$%&|<>"
SEPARATORS = r"|»›·•"

BOILERPLATE = (
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)"
    r"|we use cookies|(enable|requires) javascript|click here|read more|skip to content"
    r"|(sign|log) (in|up) to|subscribe to our|share (this|on) |powered by|back to top"
)

RULES = ("navigation", "symbols", "shouting", "stutter", "unpunctuated", "boilerplate")


def _only(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are of the class ``chars``."""
    return F.char_length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _line(line: Column) -> Column:
    """Measures of a line."""
    words = blank_split(line)
    return F.struct(
        line.alias("line"),
        words.alias("words"),
        F.char_length(F.array_join(words, "")).alias("chars"),
    )


def _verdict(x: Column) -> Column:
    """The line, its characters in words, and the first rule that it fails."""
    line, words, chars = x["line"], x["words"], x["chars"]
    n = F.size(words)
    again = F.size(F.filter(F.zip_with(words, F.slice(words, 2, n), lambda a, b: a == b), lambda e: e))
    separators = _only(line, SEPARATORS)
    rule = (
        F.when((separators >= 3) & (4 * separators >= n), "navigation")
        .when(10 * _only(line, r"#*$%&|<>{}\[\]=_~^\\") > chars, "symbols")
        .when(
            line.rlike(rf"!({BLANK}|$)[\s\S]*!({BLANK}|$)")
            & (10 * _only(line, r"\p{Lu}") > 6 * _only(line, r"\p{L}")),
            "shouting",
        )
        .when((n >= 8) & (10 * again >= 3 * n), "stutter")
        .when((n >= 12) & ~line.rlike("[.!?…:;,。！？]"), "unpunctuated")
        .when((n <= 25) & line.rlike(BOILERPLATE), "boilerplate")
    )
    return F.struct(line.alias("line"), chars.alias("chars"), rule.alias("rule"))


def _window_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def judge(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns, the base measures
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, then
    n_lines (with a word), n_failed (an array of struct rule, lines), lost (the share
    of characters in words that failing lines hold), cleaned_text and kept.

    cleaned_text is the text without its failing lines; it is the text itself if no
    line fails. NULL, empty and blank texts have no words, so they fail the base
    rules and are not kept. Words are compared by a 64-bit hash within a document.
    Repeated rows are all returned. A carried column named like a result gives way
    to it; other columns are dropped.
    """
    results = (
        "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_lines n_failed "
        "lost cleaned_text kept doc_id"
    ).split()
    carry = tuple(c for c in carry if c not in results)
    rest = F.struct(F.col("doc_id"), *(F.col(c) for c in carry)).alias("rest")
    text = F.coalesce("text", F.lit(""))
    step = docs.select(rest, text.alias("text"))
    step = step.select(
        "rest", "text", blank_split(F.col("text")).alias("words"), F.split("text", "\n").alias("lines")
    )
    step = step.select(
        "rest",
        "text",
        "lines",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _only(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        F.filter("lines", lambda x: x.rlike(f"[^{BLANK[1:]}")).alias("worded"),
        _window_hashes(F.col("words")).alias("hashes"),
    )
    places = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), F.size("hashes") - WINDOW))
    step = step.withColumns(
        {
            "n_dup_lines": (F.size("worded") - F.size(F.array_distinct("worded"))).cast("bigint"),
            "windows": F.transform(
                F.coalesce(places, F.array().cast("array<int>")),
                lambda i: F.xxhash64(*(F.get(F.col("hashes"), i + k) for k in range(WINDOW))),
            ),
            "judged": F.transform(F.transform("lines", _line), _verdict),
        }
    )
    # Windows that occur again stand side by side once sorted.
    step = step.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    both = F.zip_with(
        F.col("sorted"),
        F.slice("sorted", 2, F.size("sorted")),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    step = step.withColumn("at", F.sort_array(F.array_distinct(F.flatten(F.coalesce(both, F.array().cast("array<array<int>>"))))))
    gaps = F.zip_with(
        "at", F.slice("at", 2, F.size("at")), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
    )
    failed = F.filter("judged", lambda x: x["rule"].isNotNull())
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda s, x: s + x["chars"])
    step = step.withColumns(
        {
            "n_repeat_words": F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, g: s + g),
            "n_lines": F.size("worded").cast("bigint"),
            "failed": failed,
        }
    )

    def failing(rule: str) -> Column:
        return F.size(F.filter("failed", lambda x: x["rule"] == rule)).alias("lines")

    step = step.withColumns(
        {
            "base_failed": F.expr(
                f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
            ),
            "n_failed": F.array(*(F.struct(F.lit(rule).alias("rule"), failing(rule)) for rule in RULES)),
            "lost": F.when(F.col("word_chars") > 0, total("failed") / F.col("word_chars")).otherwise(0.0),
            "cleaned_text": F.when(F.size("failed") == 0, F.col("text")).otherwise(
                F.array_join(
                    F.transform(
                        F.filter("judged", lambda x: x["rule"].isNull()), lambda x: x["line"]
                    ),
                    "\n",
                )
            ),
        }
    )
    judged = step.select(
        F.col("rest.doc_id").alias("doc_id"),
        *(F.col("rest")[c].alias(c) for c in carry),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_lines",
        "n_failed",
        "lost",
        "cleaned_text",
        (~F.col("base_failed") & (F.col("lost") <= MOST_LOST)).alias("kept"),
    )
    return computed(judged)
