"""Which rows a classifier may learn from, and its labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: Column | str) -> Column:
    """Fold 0 to 4 of a document by its id; fold 0 is held out. NULL counts as no text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and label of the documents that have one; of several the greatest counts."""
    known = labels.filter(f"doc_id IS NOT NULL AND {name} IS NOT NULL")
    return known.groupBy("doc_id").agg(F.max(name).cast("int").alias("label"))
