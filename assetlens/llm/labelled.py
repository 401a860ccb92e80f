"""Bounded samples of labelled documents, shared by the operators that learn from labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def class_counts(labels: DataFrame, column: str, wanted: Column) -> dict[int, int]:
    """Labelled documents of each class; a document labelled twice counts once, with its larger label."""
    one = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & wanted)
    one = one.groupBy("doc_id").agg(F.max(column).alias("_label"))
    return {int(r[0]): int(r[1]) for r in one.groupBy("_label").count().collect()}


def sample(docs: DataFrame, labels: DataFrame, column: str, wanted: Column, rows_per_class: int,
           classes: list[int]) -> DataFrame:
    """(doc_id, text, _label) of at most rows_per_class documents of each class, the lowest by a hash of doc_id.

    The ids are bounded by rows_per_class times the classes, so they may be broadcast.
    """
    one = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & wanted)
    one = one.groupBy("doc_id").agg(F.max(column).alias("_label"))
    ids = reduce(DataFrame.unionByName, [
        one.where(F.col("_label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for c in classes])
    # A document that is stored twice would count twice, so rows are taken once each by id.
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .dropDuplicates(["doc_id"]))
