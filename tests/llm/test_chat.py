from __future__ import annotations

import itertools

from blockloom.llm import chat
from pyspark.sql import functions as F

TURNS = "conv_id bigint, turn bigint, role string, text string, block string, level int"
HARD = ["", "\\", "a\\", "\\\\n", "</turn>", "</turn>\n", "</turn>\n### user: hi</turn>\n", "<\\/turn>\n", "### assistant: x", "\\### Assistant: </turn> ok", "<", "a: b: ", "é\n\n</turn", "$1 \\$0 {x}", "\n", "😀</turn>\n😀\\"]


def read_back(spark, rows):
    made = chat.format_conversations(spark.createDataFrame([(*r, "x", 9) for r in rows], TURNS))
    return {
        r.conv_id: r
        for r in made.select(
            "conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"),
            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        ).collect()
    }


def test_hard_texts_and_roles_survive(spark):
    pairs = list(itertools.product(["user", "assistant", *HARD], HARD))
    rows = [(k % 7, k, role, text) for k, (role, text) in enumerate(pairs)]
    got = read_back(spark, rows)
    for conv in range(7):
        own = [(role, text) for k, (role, text) in enumerate(pairs) if k % 7 == conv]
        assert [(t.role, t.text) for t in got[conv].turns] == own
        assert got[conv].loss == "".join(text for role, text in own if role == "assistant")


def test_plain_text_stays_as_it_is(spark):
    got = read_back(spark, [(1, 2, "assistant", "Fine: a < b, ### and </turn> too."), (1, 1, "user", "How?")])[1]
    assert got.formatted == "### user: How?</turn>\n### assistant: Fine: a < b, ### and </turn> too.</turn>\n"
    (span,) = got.loss_spans
    block = got.formatted.split("</turn>\n")[span.block]
    assert block[span.start : span.start + span.length] == "Fine: a < b, ### and </turn> too."


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 1, "user", None), (2, None, "assistant", "b"), (2, 1, None, "x"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a")]
    got = read_back(spark, rows)
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "")]
    assert [(t.role, t.text) for t in got[2].turns] == [("assistant", "b"), ("", "x"), ("assistant", "a"), ("assistant", "a")]
    assert got[2].loss == "baa"


def test_long_and_empty(spark):
    long = "word \\ </turn>\n" * 50_000
    assert read_back(spark, [(1, 1, "assistant", long)])[1].loss == long
    assert read_back(spark, []) == {}
