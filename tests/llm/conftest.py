from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    """A frame of documents from (doc_id, text) pairs, with columns that clash."""

    def make(rows, extra=True):
        made = spark.createDataFrame(
            [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS
        )
        if extra:
            for name in ("print", "component_id", "n_words", "score", "words", "key", "rep"):
                made = made.selectExpr("*", f"'x' AS {name}")
        return made

    return make
