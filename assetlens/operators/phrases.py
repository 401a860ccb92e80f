"""Whole-phrase search of many texts for many phrases, as an equi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, phrase_in

ANCHOR_WORDS = 6


def _anchor(words, size):
    return F.xxhash64(F.array_join(F.slice(words, 1, size), " "), F.lit(size))


def phrase_hits(texts: DataFrame, phrases: DataFrame, text_id: str, text: str,
                phrase_id: str, phrase: str) -> DataFrame:
    """Pairs (phrase, text) where the normalised phrase occurs as whole words.

    Equal phrases are searched once. The first words of a phrase are its anchor; texts
    emit only the hashes of their word windows, so no text is shuffled with its windows,
    and the few candidate pairs are verified on the text itself.
    """
    distinct = (phrases.filter(F.col(phrase) != "").select(F.col(phrase).alias("_phrase")).distinct()
                .withColumn("_words", F.split("_phrase", " "))
                .withColumn("_size", F.least(F.size("_words"), F.lit(ANCHOR_WORDS)))
                .withColumn("_hash", _anchor(F.col("_words"), F.col("_size"))))
    sizes = sorted(r[0] for r in distinct.select("_size").distinct().collect())  # at most ANCHOR_WORDS rows
    empty = F.array().cast("array<bigint>")

    def windows(words, size):
        starts = F.sequence(F.lit(1), F.size(words) - size + 1)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, size), " "), F.lit(size)))
        return F.when(F.size(words) >= size, hashes).otherwise(empty)

    hashes = let(F.split(text, " "), lambda words: F.array_distinct(
        F.concat(*[windows(words, s) for s in sizes]) if sizes else empty))
    keyed = texts.select(text_id, F.explode(hashes).alias("_hash"))
    candidates = keyed.join(distinct.select("_hash", "_phrase"), "_hash").select(text_id, "_phrase").distinct()
    found = (texts.select(text_id, text).join(candidates, text_id)
             .filter(phrase_in(F.col("_phrase"), F.col(text))).select(text_id, "_phrase"))
    return found.join(phrases.select(phrase_id, F.col(phrase).alias("_phrase")), "_phrase").select(phrase_id, text_id)
